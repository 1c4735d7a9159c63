"""Embedding near-duplicates: all pairs of vectors with the same label and a cosine of 0.98
or more, as link counts and groups.

1. Equal vectors of a label are one class from here on.
2. Randomised rotation: a vector is turned by seeded orthogonal matrices and kept as the
   signs of its coordinates, a binary code, with a correction factor, the inner product
   of the vector and its own code.
3. Bits of the codes make bands; there are so many that a pair at the threshold shares one
   with probability RECALL. Rows shuffle on (label, band, bits). The width of a band grows
   with the logarithm of the number of classes, so buckets of unlike vectors stay small.
4. In a bucket, code and factor estimate the inner product with any other vector without
   bias, with a bound that holds but for SIGMAS standard errors. Only pairs whose estimate
   plus bound reaches the threshold are recomputed exactly, in double precision.
5. A pair counts in the first band that it shares. A large bucket is cut into blocks and
   each pair of blocks is a unit of its own. Tasks return counts and forests, never pairs.

Defined cases: a vector that is NULL, empty or all zero, or holds NULL, NaN or infinity,
and one with a NULL label link with nothing; vectors of different lengths are not compared;
rows with equal vec_id are vectors of their own; a NULL vec_id takes part and is not kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import cut, groups_of, has_columns, ship_package, shuffle_partitions
from stockflow.llm.graph import components
from stockflow.llm.ngram_join import forest

THRESHOLD = 0.98
RECALL = 0.9999
SIGMAS = 5.0
SEED = 20
BLOCK = 2048
LEAST_BITS, MOST_BITS = 12, 40


def band_plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """How many bands of how many bits, for ``n`` different vectors."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(n, 2)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - agree)), bits


def rotations(dim: int, n: int) -> list[np.ndarray]:
    """Seeded random orthogonal matrices."""
    found = []
    for i in range(n):
        q, r = np.linalg.qr(np.random.default_rng([SEED, dim, i]).standard_normal((dim, dim)))
        found.append(q * np.sign(np.diag(r)))
    return found


def _valid_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, vector -> key (NULL if the vector links with nothing), vec_id, label, bytes."""
    for batch in batches:
        vec_ids, labels, vectors = batch.columns
        lists = vectors.cast(pa.large_list(pa.float64())).to_pylist()
        keys, raws = [], []
        for label, values in zip(labels.to_pylist(), lists, strict=True):
            key = raw = None
            if label is not None and values and None not in values:
                vector = np.array(values)
                if np.isfinite(vector).all() and vector.any():
                    raw = vector.tobytes()
                    key = hashlib.md5(label.encode() + b"\0" + raw).digest()
            keys.append(key)
            raws.append(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), vec_ids, labels, pa.array(raws, pa.binary())],
            names=["key", "vec_id", "label", "vector"],
        )


def _by_length(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors, for each length that occurs."""
    lengths = np.array([len(raw) // 8 for raw in raws])
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        rows = np.frombuffer(b"".join(raws[i] for i in at.tolist())).reshape(len(at), dim)
        # scale first, so that very large and very small values keep a finite norm
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        yield at, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _bands(n_bands: int, bits: int):
    """Add ``codes`` (the band values, 8 bytes each) and ``buckets`` (a key per band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            raws, labels = batch.column(2).to_pylist(), batch.column(1).to_pylist()
            codes, buckets = [b""] * len(raws), [[]] * len(raws)
            for at, units in _by_length(raws):
                dim = units.shape[1]
                if dim not in turned:
                    turned[dim] = rotations(dim, -(-n_bands * bits // dim))
                signs = np.concatenate([units @ q for q in turned[dim]], axis=1)[:, : n_bands * bits] > 0
                weights = np.int64(1) << np.arange(bits, dtype=np.int64)
                values = signs.reshape(len(at), n_bands, bits) @ weights
                for i, row in zip(at.tolist(), values, strict=True):
                    codes[i] = row.tobytes()
                    buckets[i] = [
                        f"{band}|{dim}|{value}|{labels[i]}" for band, value in enumerate(row.tolist())
                    ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.binary()), pa.array(buckets, pa.list_(pa.string()))],
                names=["key", "codes", "buckets"],
            )

    return run


def estimated(units: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of ``units``, known by code and factor alone, with ``others``; and how
    far each row may be off."""
    dim = units.shape[1]
    (turn,) = rotations(dim, 1)
    codes, factors = encode(units, turn)
    products = (codes.astype(np.float64) * 2 - 1) @ (others @ turn).T / math.sqrt(dim)
    spread = np.sqrt(np.maximum(1 - factors**2, 0)) / factors / math.sqrt(max(dim - 1, 1))
    return products / factors[:, None], SIGMAS * spread + 1e-9


def encode(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The binary code of unit vectors, and the correction factor stored with it."""
    turned = units @ turn
    return turned > 0, np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])


_LINKS_DDL = "key binary, links long, other binary"
_LINKS = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("other", pa.binary())])


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit in groups_of(batches, "unit"):
        keys, side = unit.column("key").to_pylist(), unit.column("side").to_numpy()
        copies, band = unit.column("copies").to_numpy(), unit.column("band")[0].as_py()
        raws = unit.column("vector").to_pylist()
        # one label and one length per bucket
        ((_, units),) = _by_length(raws)
        codes = np.frombuffer(b"".join(unit.column("codes").to_pylist()), np.int64).reshape(len(keys), -1)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        twin = unit.column("twin")[0].as_py()
        if twin:
            right = left
        if not len(left) or not len(right):
            continue
        products, bounds = estimated(units[left], units[right])
        a, b = np.nonzero(products + bounds[:, None] >= THRESHOLD)
        if twin:
            a, b = a[a < b], b[a < b]
        a, b = left[a], right[b]
        for start in range(0, len(a), 1 << 16):
            part = slice(start, start + (1 << 16))
            exact = np.einsum("ij,ij->i", units[a[part]], units[b[part]]) >= THRESHOLD
            # a pair counts in the first band that both share
            exact &= ~(codes[a[part], :band] == codes[b[part], :band]).any(axis=1)
            a[part] = np.where(exact, a[part], -1)
        b, a = b[a >= 0], a[a >= 0]
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        some = np.flatnonzero(counts)
        edges = []
        if len(some):
            place = np.cumsum(counts > 0) - 1
            links = np.zeros((len(some), len(some)), bool)
            links[place[a], place[b]] = links[place[b], place[a]] = True
            edges = [(some[i], some[j]) for i, j in forest(links)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[i] for i in some] + [keys[i] for i, _ in edges], pa.binary()),
                pa.array(np.concatenate([counts[some], np.zeros(len(edges), np.int64)])),
                pa.array([None] * len(some) + [keys[j] for _, j in edges], pa.binary()),
            ],
            schema=_LINKS,
        )


def _links_between(classes: DataFrame, n_classes: int) -> DataFrame:
    """Links per class and edges between classes."""
    n_bands, bits = band_plan(n_classes)
    banded = cut(
        classes.select("key", "label", "vector").mapInArrow(_bands(n_bands, bits), "key binary, codes binary, buckets array<string>")
    )
    rows = banded.select("key", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    placed = rows.join(shared.withColumn("blocks", F.ceil(F.col("n") / BLOCK)), "bucket").withColumn(
        "block", F.pmod(F.xxhash64("key"), "blocks")
    )
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    units = paired.select(
        F.concat_ws(",", "bucket", low, high).alias("unit"),
        F.substring_index("bucket", "|", 1).cast("int").alias("band"),
        (low == high).alias("twin"),
        F.when(F.col("block") == low, 0).otherwise(1).alias("side"),
        "key",
    )
    facts = classes.select("key", "copies", "vector").join(banded.select("key", "codes"), "key")
    whole = units.join(facts, "key")
    n = shuffle_partitions(classes.sparkSession)
    return whole.repartition(n, "unit").sortWithinPartitions("unit", "key").mapInArrow(_link, _LINKS_DDL)


def similar_vectors(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    ship_package(embeddings.sparkSession)
    rows = has_columns(embeddings, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding"
    )
    read = cut(rows.mapInArrow(_valid_rows, "key binary, vec_id long, label string, vector binary"))
    classes = cut(
        read.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
    )
    checked = cut(_links_between(classes, classes.count()))
    links = checked.where(F.col("other").isNull()).groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(checked.where(F.col("other").isNotNull()).select(F.col("key").alias("a"), F.col("other").alias("b")))
    named = groups.join(classes.select(F.col("key").alias("node"), "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    group_of = groups.join(smallest, "component").select(F.col("node").alias("key"), "smallest")
    facts = (
        classes.select("key", "rep", "copies")
        .join(links, "key", "left")
        .join(group_of, "key", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("smallest", "rep").alias("smallest"),
        )
    )
    # vectors that link with nothing have no key to meet on: they would all be one
    linkable = read.where(F.col("key").isNotNull()).select("key", "vec_id").join(facts, "key").select("vec_id", "n_links", F.col("smallest").alias("component_id"))
    alone = read.where(F.col("key").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linkable.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
