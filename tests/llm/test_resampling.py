"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stockflow.llm import resampling as r
from stockflow.llm.shingles import text_slices
from tests.llm.helpers import COLUMNS, documents, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["A b, Cé d9 " + "z" * 700 + " end", "", None, "x", "Über-Maß 12 a\x00b", "é", " ", "a" * 300 + " " + "b" * 256]


def features(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)], len(words)


def bucket(feature):
    return zlib.crc32(feature.encode()) % r.BUCKETS


def plain(rows, target, percent=5, min_words=20):
    """doc_id, n_features, weight, score, rank of each row."""
    corpus = Counter(bucket(f) for row in rows for f in features(row[1])[0])
    wanted = Counter(bucket(f) for text in target for f in features(text)[0])
    n, m = sum(corpus.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (n + r.BUCKETS) / ((corpus[b] + 1) * (m + r.BUCKETS))))
        for b in range(r.BUCKETS)
    ]
    found = []
    for row in rows:
        own, n_words = features(row[1])
        h = int(hashlib.sha256(f"42:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in own)
        found.append([row[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((x for x in found if x[4] >= min_words), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[2], x[1]))
    drawn = percent * len(able) // 100
    return [(*x[:4], i + 1 if i < drawn else None) for i, x in enumerate(able)] + [(*x[:4], None) for x in found if x[4] < min_words]


def test_buckets_of_joined_words():
    for data, edges in text_slices(pa.array(ODD), 600):
        assert len(data) == edges[-1]
    found, start = [], 0
    for data, edges in text_slices(pa.array(ODD), 600):
        buckets, texts, _ = r.feature_buckets(data, edges)
        found += zip((texts + start).tolist(), buckets.tolist())
        start += len(edges) - 1
    assert sorted(found) == sorted((i, bucket(f)) for i, text in enumerate(ODD) for f in features(text)[0])


@pytest.mark.parametrize("low, high", [(-9000, 9000), (0, 1), (-1, 0), (5, 4096), (-4096, -5)])
def test_planes_add_up(low, high):
    rng = np.random.default_rng(3)
    gain = rng.integers(low, high, r.BUCKETS, endpoint=True)
    counts = rng.integers(0, 4, (40, r.BUCKETS))
    counts[3], counts[4, 7] = 0, 70_000
    assert (r.plane_weights(counts, *r.gain_planes(gain)) == counts @ gain).all()


def test_ranks_equal_a_plain_version(spark, rows):
    docs, target = odd_documents(), ["one two three", None, odd_documents()[6][1]]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = r.importance_ranks(documents(spark, docs), wanted, percent=50, keep=("doc_id",))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    expected = plain([d[:2] for d in docs], target, percent=50)
    assert rows(found) == sorted(expected, key=repr)
    assert sum(row[4] is not None for row in expected) > 5


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    docs = documents(spark).selectExpr("*", "'mine' AS weight", "1 AS score", "2 AS rank", "3 AS __words", "4 AS bucket")
    drawn = r.resample(docs, docs.select("text"), percent=30)
    assert [c for c in drawn.columns] == ["doc_id", "text", "lang", "source", "n_chars", "bucket", *r.ADDED]
    got = drawn.collect()
    assert got and sorted(row["rank"] for row in got) == list(range(1, len(got) + 1))
    assert all(row["bucket"] == 4 and len(features(row["text"])[0]) == row["n_features"] for row in got)


def test_empty_tables(spark, rows):
    none, some = spark.createDataFrame([], COLUMNS), documents(spark)
    assert r.importance_ranks(none, some).count() == 0
    expected = plain([d[:2] for d in odd_documents()], [])
    assert rows(r.importance_ranks(some, none, keep=("doc_id",))) == sorted(expected, key=repr)
