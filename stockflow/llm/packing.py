"""Best-fit packing of documents into sequences, with certified bin counts.

1. Documents become token ids plus an end id. One longer than a sequence is cut into
   full pieces; the first may be shorter.
2. Pieces are dealt by a hash into groups of a bounded size. Each group is packed by
   best-fit decreasing, and lower bounds from dual-feasible functions (the plain sum,
   the thresholds of Martello and Toth, the staircases of Fekete and Schepers) tell how
   many sequences it needs at least. A group that meets its bound is certified: no packing
   of it is shorter.
3. Groups with a gap exchange documents: what lies in their sequences that are not full,
   and in every LENTth full one, is dealt anew into fewer groups and packed again. The new
   packing is kept if it takes fewer sequences; this repeats while it does.

Only ids' lengths and checksums move between tasks, never texts. ``packed_ids`` joins the
ids of each sequence for the training files.

Defined cases: a NULL or empty text is a document of the end id alone; rows with equal
doc_id and text are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import cut, groups_of, has_columns, releasing, ship_package, shuffle_partitions
from stockflow.llm.encoding import encoder

CAPACITY = 1024
# pieces per group, about; a group is one unit of packing in memory
GROUP_PIECES = 40_000
LENT = 8

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 (and ids)."""
    ship_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(vocabulary)
        for batch in batches:
            doc_ids, done = batch.column(0).to_pylist(), 0
            for tokens, offsets in tokenizer.encode(batch.column(1)):
                rows = []
                for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    ids = np.append(tokens[a:b], np.uint32(end_id)).astype("<u4")
                    for i, (start, length) in enumerate(_cut_lengths(len(ids), capacity)):
                        own = ids[start : start + length].tobytes()
                        rows.append((doc_ids[done + k], i, start, length, zlib.crc32(own), own))
                done += len(offsets) - 1
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns[:n], kinds[:n], strict=True)], names=names[:n]
                )

    return has_columns(docs, "doc_id", "text").mapInArrow(releasing(encode), _PIECE + (", ids binary" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length: longest first, each into the fullest bin that still takes it."""
    bins = np.zeros(len(lengths), np.int64)
    # the open bins by the room they have left; a bit set tells which rooms there are
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, used
            used += 1
        bins[i] = chosen
        left = room - length
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing can go below: the best of the dual-feasible bounds."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    total = int((count * size).sum())
    best = -(-total // capacity)
    for limit in range(1, capacity // 2 + 1):
        # over capacity - limit counts as a whole bin, under limit as nothing
        value = np.where(size > capacity - limit, capacity, np.where(size >= limit, size, 0))
        best = max(best, -(-int((count * value).sum()) // capacity))
    for k in range(1, 101):
        # a staircase in k steps; exact multiples of 1 / (k + 1) keep their size
        grown = (k + 1) * size
        value = np.where(grown % capacity == 0, k * size, grown // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _packed(rows: DataFrame, n_groups: Column, round_no: int, capacity: int) -> DataFrame:
    """Deal the rows into groups and pack each. Adds sequence_id, offset, fill, gap."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
            ("fill", pa.int64()),
            ("gap", pa.int64()),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "group"):
            lengths = group.column("length").to_numpy()
            bins = best_fit(lengths, capacity)
            n_bins = int(bins.max()) + 1
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            fill = np.bincount(bins, lengths, n_bins).astype(np.int64)
            offset = np.empty(len(bins), np.int64)
            offset[order] = ends - lengths[order] - (np.cumsum(fill) - fill)[bins[order]]
            number = (round_no << 48) + (group.column("group")[0].as_py() << 24) + bins
            gap = n_bins - least_bins(lengths, capacity)
            columns = [group.column(name).combine_chunks() for name in schema.names[:5]]
            added = [number, offset, fill[bins], np.full(len(bins), gap)]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, added)], schema=schema)

    dealt = F.pmod(F.xxhash64(F.lit(round_no), "doc_id", "piece", "ids_crc32", "start"), n_groups)
    grouped = rows.select(*schema.names[:5], dealt.alias("group"))
    return (
        grouped.repartition(shuffle_partitions(rows.sparkSession), "group")
        # in full, so that a repeated task packs the same
        .sortWithinPartitions("group", "doc_id", "piece", "ids_crc32")
        .mapInArrow(releasing(pack), _PIECE + ", sequence_id long, offset long, fill long, gap long")
    )


def _groups_for(n: int) -> Column:
    return F.lit(max(1, round(n / GROUP_PIECES))).cast("long")


def pack(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its sequence and its place there; groups exchange while that saves any."""
    rows = cut(piece_rows)
    placed = cut(_packed(rows, _groups_for(rows.count()), 0, capacity))
    for round_no in itertools.count(1):
        # whole sequences: all that are not full, and some full ones to exchange with
        lent = F.pmod(F.xxhash64(F.lit(round_no), "sequence_id"), F.lit(LENT)) == 0
        loose = (F.col("gap") > 0) & ((F.col("fill") < capacity) | (lent & (F.col("length") < capacity)))
        pool = placed.where(loose)
        n, before = pool.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("length") / F.col("fill")), F.lit(0.0))).first()
        if not n:
            break
        again = cut(_packed(pool, _groups_for(n), round_no, capacity))
        after = again.agg(F.sum(F.col("length") / F.col("fill"))).first()[0]
        if round(after) >= round(before):
            break
        # one table again, so that the plan does not grow with the rounds
        placed = cut(placed.where(~loose).unionByName(again))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", (F.col("gap") == 0).alias("certified")
    )


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, vocabulary, end_id, capacity), capacity)


def packed_ids(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id and its ids (unsigned, 32 bit, as bytes).

    Pieces with equal doc_id and checksum are the same ids, so either may take either place.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = pieces(docs, vocabulary, end_id, capacity, with_ids=True)
    one = whole.groupBy(key).agg(F.first("ids").alias("ids"))
    assigned = pack(whole.select(*key), capacity)
    same = [F.col(f"p.{name}").eqNullSafe(F.col(f"a.{name}")) for name in key]
    joined = one.alias("p").join(assigned.alias("a"), same).select("a.sequence_id", "a.offset", "p.ids")
    # a sequence holds at most ``capacity`` ids
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    in_order = F.aggregate(parts, F.lit(b""), lambda got, part: F.concat(got, part["ids"]))
    return joined.groupBy("sequence_id").agg(in_order.alias("ids"))
