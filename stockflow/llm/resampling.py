"""Importance resampling towards a target corpus, by bit-sliced sums.

Features of a text are its runs of one to three words, hashed into BUCKETS buckets. A bucket's
gain says how much more common it is in the target than in the corpus, as a whole number. The
weight of a document is the sum of the gains of its features:

1. The corpus and the target are counted per bucket: one partial count per task and bucket, added
   up by Spark. BUCKETS rows of each reach the driver, whatever the size of the corpus.
2. Gains are written as bit planes in two's complement: plane k holds bit k of every bucket's
   gain, as one string of BUCKETS bits; the last plane is the sign and counts negative.
3. The bucket counts of a document become bit planes too. Count plane j AND gain plane k, number
   of ones, times 2 ** (j + k), added over all j and k, is the exact weight.
4. A Gumbel draw from the hash of the doc_id is added; the highest scores are taken. Ranks come
   from range partitions, so neither one task nor the driver sees all scores.

The text is read twice (counts, weights) rather than stored as planes, which are no smaller.
The CRC-32 of a run of words follows from those of its words: a CRC is linear, so a prefix is
carried over the bytes behind it by table look-ups, and no run is ever put together.

Defined cases: a NULL or empty text has no features and weight 0, and is not drawn; a NULL doc_id
draws as an empty one; repeated rows are ranked each, in any order among themselves; an empty
corpus gives no rows, an empty target gains from its S and s alone; other columns are kept, but
for those named like the added ones, which are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.common import cut, has_columns, ship_package
from stockflow.llm.shingles import text_slices
from stockflow.llm.word_bytes import LETTERS_AND_DIGITS, LOWER, runs_of
from stockflow.operators.rank import global_rank

BUCKETS = 10_000
LONGEST_RUN = 3
SCALE = 1000
SEED = 42
MIN_WORDS = 20
PERCENT = 5
SLICE_BYTES = 4 << 20
BLOCK_DOCS = 128  # documents whose counts are held side by side
PLANE_BYTES = -(-BUCKETS // 64) * 8

ADDED = ("n_features", "weight", "score", "rank")

# -- CRC-32 of joined strings ---------------------------------------------------

_POLYNOMIAL = 0xEDB88320
_TABLED = 256  # lengths with a table of their own


def _one_byte() -> np.ndarray:
    """What a CRC register becomes for each value of its lowest byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(_POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


def _carry_tables() -> np.ndarray:
    """[n, k, v]: byte value v at place k of a register, carried over n bytes."""
    one = _one_byte()
    tables = np.empty((_TABLED, 4, 256), np.uint32)
    for place in range(4):
        tables[0, place] = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
    for n in range(1, _TABLED):
        before = tables[n - 1]
        tables[n] = one[before & 255] ^ (before >> 8)
    return tables


_tables: list[np.ndarray] = []


def carried(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs of strings, carried over ``n`` bytes behind them: to be XORed with the CRC of those."""
    if not _tables:
        _tables.append(_carry_tables().reshape(-1))

    def step(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        row, octets = n.astype(np.intp) << 10, np.ascontiguousarray(crc, "<u4").view(np.uint8).reshape(-1, 4)
        moved = _tables[0].take(row + octets[:, 0])
        for place in (1, 2, 3):
            moved ^= _tables[0].take(row + (octets[:, place] + np.intp(256 * place)))
        return moved

    moved = step(crc, np.minimum(n, _TABLED - 1))
    left = n - (_TABLED - 1)
    todo = np.flatnonzero(left > 0)
    while len(todo):
        some = np.minimum(left[todo], _TABLED - 1)
        moved[todo] = step(moved[todo], some)
        left[todo] -= some
        todo = todo[left[todo] > 0]
    return moved


def feature_buckets(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all features of some texts: the bucket, the text's number; and each text's words."""
    distinct, codes, offsets = runs_of(LOWER[data], edges, LETTERS_AND_DIGITS)
    words = distinct.to_pylist()
    alone = np.array([zlib.crc32(word) for word in words], np.uint32)[codes]
    behind = np.array([zlib.crc32(b" " + word) for word in words], np.uint32)[codes]
    length = np.array([len(word) + 1 for word in words], np.int64)[codes]
    n_words = np.diff(offsets)
    text = np.repeat(np.arange(len(n_words)), n_words)
    run, buckets, texts = alone, [alone % BUCKETS], [text]
    for longer in range(1, LONGEST_RUN):
        if len(run) < 2:
            break
        run = carried(run[:-1], length[longer:]) ^ behind[longer:]
        within = text[:-longer] == text[longer:]
        buckets.append(run[within] % BUCKETS)
        texts.append(text[:-longer][within])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(texts), n_words


# -- gains ------------------------------------------------------------------------


def bucket_counts(texts: DataFrame, column: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data, edges in text_slices(batch.column(0), SLICE_BYTES):
                total += np.bincount(feature_buckets(data, edges)[0], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    partial = has_columns(texts, column).mapInArrow(count, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    # one row per bucket at most
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from its counts."""
    all_corpus, all_target = int(corpus.sum()), int(target.sum())

    def gain(s: int, t: int) -> int:
        ratio = (float(t + 1) * float(all_corpus + BUCKETS)) / (float(s + 1) * float(all_target + BUCKETS))
        return math.floor(SCALE * math.log(ratio))

    return np.array([gain(s, t) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of BUCKETS bits as rows of 64-bit words."""
    packed = np.zeros((len(bits), PLANE_BYTES), np.uint8)
    packed[:, : -(-BUCKETS // 8)] = np.packbits(bits, axis=1)
    return packed.view(np.uint64)


def gain_planes(values: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The bit planes of the gains in two's complement, and what a bit of each counts."""
    width = max(int(values.max()).bit_length(), int(-values.min() - 1).bit_length() if values.min() < 0 else 0) + 1
    bits = np.stack([(values >> k) & 1 for k in range(width)]).astype(np.uint8)
    return _packed(bits), [1 << k for k in range(width - 1)] + [-(1 << (width - 1))]


def plane_weights(counts: np.ndarray, planes: np.ndarray, worth: list[int]) -> np.ndarray:
    """The sum of gains of each row of bucket counts."""
    weight, largest = np.zeros(len(counts), np.int64), counts.max(axis=1)
    for j in range(int(largest.max()).bit_length()):
        rows = np.flatnonzero(largest >= 1 << j)
        plane = _packed(((counts[rows] >> j) & 1).astype(np.uint8))
        for k, value in enumerate(worth):
            ones = np.bitwise_count(plane & planes[k]).sum(axis=1, dtype=np.int64)
            weight[rows] += ones * (value << j)
    return weight


# -- weights, scores and ranks -----------------------------------------------------


def weighted(docs: DataFrame, gain: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns, and n_words, n_features and weight of each text."""
    ship_package(docs.sparkSession)
    planes, worth = gain_planes(gain)
    read = docs.select(*[docs[name] for name in keep], docs["text"].alias("__text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for data, edges in text_slices(batch.column(len(keep)), SLICE_BYTES):
                buckets, texts, n_words = feature_buckets(data, edges)
                order = np.argsort(texts, kind="stable")
                buckets, texts = buckets[order], texts[order]
                weights = np.zeros(len(n_words), np.int64)
                for start in range(0, len(n_words), BLOCK_DOCS):
                    size = min(BLOCK_DOCS, len(n_words) - start)
                    low, high = np.searchsorted(texts, [start, start + size])
                    cells = (texts[low:high] - start) * BUCKETS + buckets[low:high]
                    counts = np.bincount(cells, minlength=size * BUCKETS).reshape(size, BUCKETS)
                    weights[start : start + size] = plane_weights(counts, planes, worth)
                done.append((n_words, np.bincount(texts, minlength=len(n_words)), weights))
            added = [np.concatenate(part) for part in zip(*done, strict=True)] if done else [np.zeros(0, np.int64)] * 3
            columns = [*batch.columns[: len(keep)], *(pa.array(one.astype(np.int64)) for one in added)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "__words", "n_features", "weight"])

    extra = [T.StructField(name, T.LongType()) for name in ("__words", "n_features", "weight")]
    return read.mapInArrow(weigh, T.StructType([*read.schema.fields[:-1], *extra]))


def _draw(doc_id: Column, seed: int) -> Column:
    """A Gumbel draw that follows from the doc_id, times SCALE."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(uniform)))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every document with n_features, weight, score and rank; the rank is NULL unless drawn.

    ``target`` has a column ``text``. Of the documents of ``min_words`` words or more,
    ``percent`` in a hundred are drawn. ``keep`` names the columns to carry (all by default).
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    names = tuple(name for name in (docs.columns if keep is None else keep) if name not in ADDED and name != "__words")
    scored = cut(
        weighted(docs, gain, names).withColumn("score", F.col("weight") + _draw(F.col("doc_id"), seed))
    )
    enough = F.col("__words") >= min_words
    # one number
    drawn = scored.where(enough).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("weight").asc(), F.col("n_features").asc()]
    ranked = global_rank(scored.where(enough), order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(*names, *ADDED)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The drawn documents, best first by ``rank``."""
    return importance_ranks(docs, target, percent, seed).where(F.col("rank").isNotNull())
