"""Toxicity: restoration of disguised words, the language model, learning and scores."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockflow.llm import toxicity as tx
from stockflow.llm.queries import QUERIES, table
from stockflow.llm.shingles import text_slices
from tests.conftest import SMALL
from tests.llm.helpers import COLUMNS, documents, odd_documents

LABELS = "doc_id long, quality int, toxic int"
WORDS = "you are such a stupid idiot and total loser this river flows along the old stone bridge".split()


def plain_counts(texts):
    """Runs of four codes by walking over the letters of each text."""
    counts = np.zeros(tx.ALPHABET**tx.ORDER, np.int64)
    for text in texts:
        # three edges stand in front of each word, one is shared with the word before
        codes = [0]
        for letter in (text or ""):
            code = 27 if ord(letter) >= 0x80 else ord(letter.lower()) - 96 if letter.isascii() and letter.isalpha() else 0
            if code or codes[-1]:
                codes.append(code)
        if codes[-1]:
            codes.append(0)
        spread = []
        for code in codes:
            spread += [code] if code else [0, 0, 0]
        for four in zip(spread, spread[1:], spread[2:], spread[3:], strict=False):
            cell = 0
            for code in four:
                cell = cell * tx.ALPHABET + code
            if any(four):
                counts[cell] += 1
    return counts


@pytest.fixture(scope="module")
def model(spark):
    texts = [(i, " ".join(WORDS[i % 5 :] + WORDS[: i % 7]), "en", "a", 1) for i in range(60)]
    return tx.language_model(documents(spark, texts))


def test_counts_equal_a_walk_over_the_letters(spark):
    rows = odd_documents()
    got = np.zeros(tx.ALPHABET**tx.ORDER, np.int64)
    for row in tx.run_counts(documents(spark, rows).repartition(5)).collect():
        got[row["run"]] = row["n"]
    # runs of edges alone lie between texts
    got[0] = 0
    assert (got == plain_counts([row[1] for row in rows])).all()


def test_probabilities_add_up_to_one(model):
    assert np.allclose(np.exp(model.astype(float)).reshape(-1, tx.ALPHABET).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize(
    "disguised",
    ["1d10t", "id!ot", "idiooooot", "i.d.i.o.t", "i d i o t", "1 d i 0 t", "i_d-i*o.t", "!diot", "IDIOT!!!", "iiidiot"],
)
def test_disguised_words_are_restored(model, disguised):
    assert tx.words_of_unit(disguised, memoryview(model)) == ["idiot"]


@pytest.mark.parametrize("unit", ["river", "stone,", "(bridge)", "21.157.205.171", "2024"])
def test_plain_units_stay(model, unit):
    letters = "".join(c for c in unit if c.isalpha())
    assert "".join(tx.words_of_unit(unit, memoryview(model))) == letters


def every_path(unit, model):
    """The best total over all combinations of readings."""
    before, options = "", []
    for sign in unit:
        options.append(tx._readings(sign, before))
        before = sign if sign != " " else before
    best = -np.inf
    for path in itertools.product(*options):
        context, total = 0, 0.0
        for written, code, cost in path:
            total -= cost
            if written is None or (code == 0 and not context):
                continue
            total += float(model[context * tx.ALPHABET + code])
            context = 0 if code == 0 else (context * tx.ALPHABET + code) % tx.ALPHABET ** (tx.ORDER - 1)
        best = max(best, total + (float(model[context * tx.ALPHABET]) if context else 0))
    return best


def path_of(unit, restored, model):
    """The best total over the combinations of readings that give ``restored``."""
    before, options = "", []
    for sign in unit:
        options.append(tx._readings(sign, before))
        before = sign if sign != " " else before
    best = -np.inf
    for path in itertools.product(*options):
        context, total, text = 0, 0.0, ""
        for written, code, cost in path:
            total -= cost
            if written is None or (code == 0 and not context):
                continue
            total += float(model[context * tx.ALPHABET + code])
            context = 0 if code == 0 else (context * tx.ALPHABET + code) % tx.ALPHABET ** (tx.ORDER - 1)
            text += written
        if text.strip() == restored:
            best = max(best, total + (float(model[context * tx.ALPHABET]) if context else 0))
    return best


@pytest.mark.parametrize("unit", ["1d10t", "a1!b", "s s t", "rr1!|", "a.b.1", "xx00x", "é1é", "*l0s"])
def test_the_path_is_the_best_of_all(model, unit):
    restored = tx.restore(unit, model)
    assert path_of(unit, restored, model) == pytest.approx(every_path(unit, model), abs=1e-4)


def test_numbers_of_units_equal_a_loop_over_texts():
    texts = ["a b c dog", None, "", "dog dog x y", "x y z w", "q q q", " one\n"]

    def read(unit):
        return [len(unit), 7] if unit != "dog" else [3]

    expected = []
    for i, text in enumerate(texts):
        tokens = (text or "").split()
        expected += [(i, n) for token in tokens for n in read(token)]
        for alone, run in itertools.groupby(tokens, key=lambda token: len(token) == 1):
            run = list(run)
            if alone and len(run) >= tx.SPACED:
                expected += [(i, n) for n in read(" ".join(run))]
    got = []
    done = 0
    for data, edges in text_slices(pa.array(texts, pa.string()), 8):
        at, numbers = tx.unit_words(data, edges, read)
        got += list(zip((at + done).tolist(), numbers.tolist(), strict=True))
        done += len(edges) - 1
    assert sorted(got) == sorted(expected)


def labelled(n=240):
    """Every third text is toxic, in plain or in disguise; the others are not."""
    insults = [*["idiot", "stupid", "loser"] * 2, "1d10t", "stuuupid", "l o s e r"]
    good = WORDS[9:]
    rows, labels, rng = [], [], random.Random(3)
    for i in range(n):
        words = [rng.choice(good) for _ in range(25)]
        if i % 3 == 0:
            words[i % 20] = insults[i // 3 % 9]
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def test_held_out_disguised_texts_are_found(spark):
    rows, labels = labelled()
    found = tx.toxicity(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert row["predicted"] == int(row["score"] >= 0.7) and 0 <= row["score"] <= 1
    tested = [row for row in found if row["held_out"]]
    assert sum(row["predicted"] == (row["doc_id"] % 3 == 0) for row in tested) >= 0.95 * len(tested)


def test_held_out_labels_do_not_matter(spark, rows):
    texts, labels = labelled()
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, other = (tx.toxicity(documents(spark, texts), spark.createDataFrame(given, LABELS)) for given in (labels, turned))
    assert rows(one) == rows(other)


def test_odd_documents(spark):
    given = odd_documents()
    labels = [(1, 1, None), (None, 1, 1), (6, 1, 1), (6, 1, 0), (9, None, 0), (7000, 0, 1)]
    docs = documents(spark, given).withColumns({"score": F.lit("x"), "toxic": F.lit(5), "terms": F.lit(None), "key": F.lit(1)})
    found = tx.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in given)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)


def test_no_usable_labels_and_empty_tables(spark):
    rows, labels = labelled(30)
    none, empty = spark.createDataFrame([], LABELS), spark.createDataFrame([], COLUMNS)
    assert {r["score"] for r in tx.toxicity(documents(spark, rows), none).collect()} == {0.0}
    assert tx.toxicity(empty, spark.createDataFrame(labels, LABELS)).collect() == []


def test_query_on_the_small_tables(spark):
    found = QUERIES["op12_toxicity"](spark, SMALL)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == table(spark, SMALL, "documents").count()
