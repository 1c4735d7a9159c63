"""Links between vectors against every pair in double precision."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm import embedding_join
from stockflow.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import groups

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows):
    vectors = []
    for _, label, values in rows:
        usable = label is not None and values and None not in values
        vector = np.array(values, float) if usable else None
        vectors.append(vector if usable and np.isfinite(vector).all() and vector.any() else None)
    links = []
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is not None and b is not None and rows[i][1] == rows[j][1] and len(a) == len(b):
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                    links.append((j, i))
    group = groups(len(rows), links)
    found = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        smallest = min(ids) if ids else None
        found.append((row[0], sum(i in link for link in links), smallest, row[0] is not None and row[0] == smallest))
    return found


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 32))
    rows = []
    for i in range(120):
        noise = rng.choice([0.0, 0.05, 0.12, 0.2])
        vector = centres[i % 6] + noise * rng.standard_normal(32)
        rows.append((i, int(i % 12 // 6), [float(np.float32(v)) for v in vector * rng.choice([1, 10])]))
    rows += [(200, 0, None), (201, 0, [0.0] * 32), (202, None, rows[0][2]), (203, 0, [float("nan")] * 32), (204, 0, []),
             (205, 0, [float("inf")] + [1.0] * 31), (206, 0, [None] + [1.0] * 31), (207, 0, rows[0][2][:16]),
             (208, 0, rows[0][2]), (208, 0, rows[0][2]), (None, 0, rows[0][2]), (209, 1, rows[0][2])]
    return rows


def in_order(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", [3, embedding_join.BLOCK])
def test_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("codes", F.lit(1))
    found = embedding_join.similar_vectors(frame).select("vec_id", "n_links", "component_id", "kept")
    assert in_order(tuple(r) for r in found.collect()) == in_order(plain(rows))


def test_all_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    found = QUERIES["op10_embedding_join"](spark, SMALL).select("vec_id", "n_links", "component_id", "kept")
    assert in_order(tuple(r) for r in found.collect()) == in_order(plain(rows))


def test_no_vectors(spark):
    assert embedding_join.similar_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    units = rng.standard_normal((300, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    found, bounds = embedding_join.estimated(units, units[:50])
    off = found - units @ units[:50].T
    assert abs(off.mean()) < 0.01
    assert (np.abs(off) <= bounds[:, None]).all()


def test_bands_reach_the_recall():
    for n in (1, 1000, 10**6, 10**12):
        bands, bits = embedding_join.band_plan(n)
        agree = (1 - np.arccos(embedding_join.THRESHOLD) / np.pi) ** bits
        assert 1 - (1 - agree) ** bands >= embedding_join.RECALL
