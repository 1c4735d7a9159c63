"""Token files, packing and quality rules."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockflow.llm import packing, quality, token_files
from stockflow.llm.common import WORD
from stockflow.llm.encoding import encoder, public_vocabulary
from stockflow.llm.queries import BYTE_VOCABULARY, END_ID, QUERIES, WORD_IDS, WORD_VOCABULARY
from stockflow.session import scratch_path
from tests.conftest import SMALL
from tests.llm.helpers import documents, odd_documents

VOCABULARIES = [WORD_VOCABULARY, BYTE_VOCABULARY]
CHARS = st.sampled_from("abzAZ09 \n\t\r.,'!<|>-_éßÉ×÷²ª \u0085　 \x1c\x1f日☃́İΣ") | st.characters(codec="utf-8")


def ids_of(vocabulary, texts):
    found = []
    for ids, offsets in encoder(public_vocabulary(vocabulary)).encode(pa.array(texts, pa.string())):
        found += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return found


def whole(vocabulary, text):
    return encoder(public_vocabulary(vocabulary)).whole(text or "")


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(CHARS, max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(vocabulary, texts):
    assert ids_of(vocabulary, texts) == [whole(vocabulary, text) for text in texts]


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
def test_ids_of_documents(spark, vocabulary):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [None, "", "I'm <|endoftext|> 's"]
    assert ids_of(vocabulary, texts) == [whole(vocabulary, text) for text in texts]


def test_token_files_of_odd_documents(spark):
    rows = odd_documents()
    folder = scratch_path(spark, "tokens")
    vocabulary = public_vocabulary(WORD_VOCABULARY)
    docs = documents(spark).selectExpr("*", "1 as start", "'x' as part")
    parts = token_files.write_token_files(docs, folder, vocabulary, END_ID, WORD_IDS)
    found = token_files.read_token_files(spark, folder).collect()
    expected, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*whole(WORD_VOCABULARY, text), END_ID], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    first = token_files.documents_ids(folder, parts[0]["part"], 0)
    assert zlib.crc32(first.astype("<u4").tobytes()) == expected[0][3] and first.dtype == np.uint16


def test_no_documents(spark):
    empty = documents(spark, [])
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(empty, folder, public_vocabulary(WORD_VOCABULARY), END_ID, WORD_IDS)
    assert token_files.read_token_files(spark, folder).count() == 0
    assert packing.pack_documents(empty, public_vocabulary(BYTE_VOCABULARY), END_ID).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0


# -- packing ---------------------------------------------------------------------------


def check_packing(rows, found, capacity):
    by_doc = Counter()
    for r in found:
        by_doc[r.doc_id] += r.length
    expected = Counter()
    for doc_id, text, *_ in rows:
        expected[doc_id] += len(whole(BYTE_VOCABULARY, text)) + 1
    assert by_doc == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(expected.values()) // capacity)


@pytest.mark.parametrize("group_pieces", [5, packing.GROUP_PIECES])
def test_packing_of_odd_documents(spark, monkeypatch, group_pieces):
    monkeypatch.setattr(packing, "GROUP_PIECES", group_pieces)
    rows = odd_documents()
    docs = documents(spark).selectExpr("*", "1 as group", "2 as gap")
    found = packing.pack_documents(docs, public_vocabulary(BYTE_VOCABULARY), END_ID, 256).collect()
    used, least = check_packing(rows, found, 256)
    assert least <= used <= 1.3 * least + 2


def test_packing_of_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op6_best_fit_packing"](spark, SMALL).collect()
    used, least = check_packing(rows, found, packing.CAPACITY)
    assert used <= 1.02 * least + 1
    for r in found:
        ids = np.array([*whole(BYTE_VOCABULARY, dict(rows)[r.doc_id]), END_ID], "<u4")
        first = len(ids) % packing.CAPACITY or packing.CAPACITY
        assert r.start == (0 if r.piece == 0 else first + (r.piece - 1) * packing.CAPACITY)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_packed_ids_are_whole_sequences(spark):
    docs = documents(spark)
    vocabulary = public_vocabulary(BYTE_VOCABULARY)
    found = [np.frombuffer(r.ids, "<u4") for r in packing.packed_ids(docs, vocabulary, END_ID, 128).collect()]
    assert all(len(ids) <= 128 for ids in found)
    expected = Counter()
    for _, text, *_ in odd_documents():
        expected.update([*whole(BYTE_VOCABULARY, text), END_ID])
    assert Counter(np.concatenate(found).tolist()) == expected


def test_bounds_never_exceed_a_packing():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([10, 64, 100])
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(1, 40))])
        bins = packing.best_fit(lengths, capacity)
        assert np.bincount(bins, lengths).max() <= capacity
        assert packing.least_bins(lengths, capacity) <= bins.max() + 1
    # sizes just over half: the plain sum says 4, each needs a bin of its own
    assert packing.least_bins(np.array([6] * 6), 10) == 6


# -- quality ------------------------------------------------------------------------------


def plain_statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = sum(char in "#*$%&|<>" for char in text or "")
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)


def test_statistics(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [t for _, t, *_ in odd_documents() if t is not None] + ["a\nb\na\n \n \nb#*", "a b c d e " * 30]
    assert [quality.text_statistics(t) for t in texts] == [plain_statistics(t) for t in texts]


def test_judged_documents(spark):
    rows = odd_documents()
    docs = documents(spark).selectExpr("*", "1 as n_words", "'x' as kept", "2 as quality")
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 0, 0), (3, None, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.judge(docs, labels).collect()
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert Counter(tuple(r)[:6] for r in found) == Counter((r[0], *plain_statistics(r[1])) for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in found)


def test_learned_rules_hold_on_other_documents(spark):
    """Rules learned from one half of the labels drop bad documents of the other half only."""
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rules = quality.learn_from_labels(docs, labels.where("doc_id % 2 = 0"))
    assert rules and quality.verdict(rules) is not None and "drop" in quality.describe(rules)
    judged = quality.statistics(docs.join(labels.where("doc_id % 2 = 1"), "doc_id")).where(~quality.base_failed())
    found = {(r.quality, r.kept): r.n for r in judged.groupBy("quality", quality.verdict(rules).alias("kept")).agg({"doc_id": "count"}).withColumnRenamed("count(doc_id)", "n").collect()}
    assert found.get((0, False), 0) >= 5 * found.get((0, True), 0)
    assert found.get((1, False), 0) <= 0.02 * found[(1, True)]


def test_a_planted_rule_is_found():
    rng = np.random.default_rng(0)
    values = {"a": rng.integers(0, 100, 3000), "b": rng.integers(0, 100, 3000)}
    bad = (values["a"] >= 60) & (values["b"] < 30)
    rules = quality.learn(values, bad, np.arange(3000) % 3 != 0)
    held = np.zeros(3000, bool)
    for rule in rules:
        held |= quality._covered(rule, values, 3000)
    assert (held == bad).mean() > 0.97
