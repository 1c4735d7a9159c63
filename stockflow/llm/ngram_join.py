"""N-gram Jaccard join: all pairs of texts whose sets of word 5-grams have a Jaccard
similarity of 0.8 or more, as link counts and groups.

1. Equal texts are one class from here on.
2. MinHash banding. ROWS minimum hashes make a band; there are so many bands that a pair
   at the threshold shares one with probability RECALL (0.9999). Rows shuffle on band
   hashes.
3. In a band's bucket rows meet a stream of pivots: a row is compared with the pivots so
   far by small sketches of its signature. Close rows are linked to the pivot and leave,
   the others become pivots too. That is done on each side of the shuffle, so a bucket that
   holds a third of all rows leaves each map task as a few pivots.
   By the triangle inequality of the Jaccard distance, two rows at the threshold both link
   to a common pivot or to linked ones, so they end in one cluster.
4. Every pair in a cluster is verified on the full sets, as products of block matrices.
   A large cluster is cut into blocks and each pair of blocks is a unit of its own. Tasks
   return counts and the edges of a spanning forest, never the pairs.
5. Links between classes count once per copy. Groups are connected components.

Counting the links inside one cluster of n different texts compares n * n / 2 pairs, in
blocks; nothing is sampled or cut off.

Defined cases: words are runs without ASCII white space. A text of one to four words has
one n-gram of them all. A text without words, or NULL, links with nothing, not even with
its equals. Rows with equal doc_id and text count as copies. NULL doc_ids take part; a
group of NULL doc_ids alone has a NULL class_id. An empty table gives no rows, and other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import cut, free_name, groups_of, has_columns, releasing, ship_package, shuffle_partitions
from stockflow.llm.graph import components
from stockflow.llm.shingles import mixed, shingle_hashes, text_slices

# similarity as a fraction, so that the test on whole numbers is exact
THRESHOLD = (4, 5)
RECALL = 0.9999
ROWS = 4
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - (THRESHOLD[0] / THRESHOLD[1]) ** ROWS))
SKETCH = 64  # one byte of so many minimum hashes
# estimated similarity from which a row links to a pivot, and from which it needs no other
JOINS, CORE = 0.4, 0.75
# the same between pivots that different tasks chose
JOINS_AGAIN = 0.25
BLOCK_TEXTS, BLOCK_SHINGLES = 2048, 2_000_000
COLUMNS = 4096  # n-grams multiplied at a time

_seeds = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY, _ADD = _seeds[: BANDS * ROWS] | np.uint64(1), _seeds[BANDS * ROWS :]


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minimum hashes (32 bit) of texts that have shingles: one row per text."""
    found = np.empty((len(starts), BANDS * ROWS), np.uint32)
    for i in range(BANDS * ROWS):
        hashed = ((shingles * _MULTIPLY[i] + _ADD[i]) >> np.uint64(32)).astype(np.uint32)
        found[:, i] = np.minimum.reduceat(hashed, starts)
    return found


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """A 64-bit hash per band, different for different bands."""
    rows = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        total = mixed(total + rows[:, :, i])
    return total.view(np.int64)


_SIGNED_DDL = "key binary, doc_id long, n_shingles long, sketch binary, bands array<long>"
_SIGNED = pa.schema(
    [
        ("key", pa.binary()),
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("sketch", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for data, edges in text_slices(batch.column(1)):
            n = len(edges) - 1
            raw = data.tobytes()
            keys = [hashlib.md5(raw[a:b]).digest() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            shingles, offsets = shingle_hashes(data, edges)
            counts = np.diff(offsets)
            some = np.flatnonzero(counts)
            sketches, bands = [None] * n, [None] * n
            if len(some):
                signed = signatures(shingles, offsets[:-1][some])
                small = signed[:, :SKETCH].astype(np.uint8)
                for i, sketch, hashes in zip(some.tolist(), small, band_hashes(signed).tolist(), strict=True):
                    sketches[i], bands[i] = sketch.tobytes(), hashes
            columns = [keys, batch.column(0).slice(done, n), counts, sketches, bands]
            done += n
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) if not isinstance(c, pa.Array) else c for c, t in zip(columns, _SIGNED, strict=True)], schema=_SIGNED)


def signed_documents(docs: DataFrame) -> DataFrame:
    """One row per document: key (of its text), doc_id, n_shingles, sketch, bands."""
    ship_package(docs.sparkSession)
    return has_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(_sign), _SIGNED_DDL)


# -- candidates ------------------------------------------------------------------

# a bucket's row: either a text with its sketch, or an edge found before
_BUCKET_DDL = "h long, key binary, sketch binary, other binary"
_BUCKET = pa.schema([("h", pa.int64()), ("key", pa.binary()), ("sketch", pa.binary()), ("other", pa.binary())])


class _Bucket:
    """The pivots of one bucket, met by its rows in turn. Edges span the groups that form:
    a row that links to several pivots of one group gives one edge."""

    def __init__(self, joins: float):
        self._joins = joins
        self._parent: list[int] = []  # of each pivot, up to the root of its group
        self.keys: list[bytes] = []
        self.sketches: list[np.ndarray] = []
        self.edges: list[tuple[bytes, bytes]] = []

    def _root(self, pivot: int) -> int:
        while self._parent[pivot] != pivot:
            self._parent[pivot] = pivot = self._parent[self._parent[pivot]]
        return pivot

    def meet(self, keys: list[bytes], sketches: np.ndarray) -> None:
        left, group = np.arange(len(keys)), np.full(len(keys), -1)
        pivot = 0
        while len(left):
            if pivot == len(self.keys):
                # the first row that is left becomes a pivot, in the group it is in already
                first, left = int(left[0]), left[1:]
                self.keys.append(keys[first])
                self.sketches.append(sketches[first])
                self._parent.append(pivot if group[first] < 0 else self._root(int(group[first])))
            alike = (sketches[left] == self.sketches[pivot]).mean(axis=1)
            close = left[alike >= self._joins]
            fresh = close[group[close] < 0]
            self.edges += [(keys[i], self.keys[pivot]) for i in fresh.tolist() if keys[i] != self.keys[pivot]]
            others = close[group[close] >= 0]
            for one, at in zip(*np.unique(group[others], return_index=True), strict=True):
                if self._root(int(one)) != self._root(pivot):
                    self._parent[self._root(int(one))] = self._root(pivot)
                    self.edges.append((keys[int(others[at])], self.keys[pivot]))
            group[fresh] = pivot
            left = left[alike < CORE]
            pivot += 1


def _reduce_buckets(joins: float, keep_pivots: bool):
    """For rows ordered by bucket: yields the edges, and the pivots if they go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bucket = None, _Bucket(joins)
        out: list[tuple] = []

        def close() -> None:
            if keep_pivots:
                out.extend((current, k, s.tobytes(), None) for k, s in zip(bucket.keys, bucket.sketches, strict=True))
            out.extend((current, a, None, b) for a, b in bucket.edges)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, _BUCKET, strict=True)], schema=_BUCKET
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(3)
            if found.null_count < len(found):
                yield batch.filter(found.is_valid())
                batch = batch.filter(found.is_null())
                if not batch.num_rows:
                    continue
            hashes = batch.column(0).to_numpy()
            begins = np.concatenate([[0], np.flatnonzero(hashes[1:] != hashes[:-1]) + 1])
            ends = np.append(begins[1:], len(hashes))
            # a bucket of one row, neither first nor last of the batch, is done with
            lone = np.flatnonzero(ends - begins == 1)
            lone = lone[(lone > 0) & (lone < len(begins) - 1)]
            if keep_pivots and len(lone):
                yield batch.take(pa.array(begins[lone]))
            for i in np.setdiff1d(np.arange(len(begins)), lone).tolist():
                a, b = int(begins[i]), int(ends[i])
                if current is not None and hashes[a] != current:
                    close()
                    bucket = _Bucket(joins)
                current = int(hashes[a])
                rows = batch.slice(a, b - a)
                sketches = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(b - a, SKETCH)
                bucket.meet(rows.column(1).to_pylist(), sketches)
            if len(out) > 10_000:
                yield batch_of(out)
                out.clear()
        if current is not None:
            close()
        if out:
            yield batch_of(out)

    return run


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Edges (a, b) whose components hold every pair that shares a band and may be similar."""
    n = shuffle_partitions(classes.sparkSession)
    rows = classes.where(F.col("n_shingles") > 0).select(
        F.explode("bands").alias("h"), "key", "sketch", F.lit(None).cast("binary").alias("other")
    )
    # pivots per map task first, then per bucket
    combined = rows.sortWithinPartitions("h", "key").mapInArrow(_reduce_buckets(JOINS, True), _BUCKET_DDL)
    met = combined.repartition(n, "h").sortWithinPartitions("h", "key").mapInArrow(
        _reduce_buckets(JOINS_AGAIN, False), _BUCKET_DDL
    )
    return met.select(F.col("key").alias("a"), F.col("other").alias("b")).distinct()


# -- verification -----------------------------------------------------------------


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by its set of n-gram hashes, sorted."""
    for batch in batches:
        place, done = batch.schema.get_field_index("text"), 0
        for data, edges in text_slices(batch.column(place)):
            n = len(edges) - 1
            shingles, offsets = shingle_hashes(data, edges)
            sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            part = batch.slice(done, n)
            done += n
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in names), pa.array(sets, pa.binary())], names=[*names, "grams"])


def linked(sets: list[np.ndarray], others: list[np.ndarray] | None) -> np.ndarray:
    """Which pairs reach the threshold: sets against others, or against each other."""
    every = sets + (others or [])
    sizes = np.array([len(one) for one in every])
    values, codes = np.unique(np.concatenate(every), return_inverse=True)
    rows = np.repeat(np.arange(len(every)), sizes)
    # an n-gram of one text alone is in no intersection
    counts = np.bincount(codes)
    number = np.cumsum(counts > 1) - 1
    shared = counts[codes] > 1
    rows, codes = rows[shared], number[codes[shared]]
    order = np.argsort(codes, kind="stable")
    rows, codes = rows[order], codes[order]
    n = len(sets)
    top = np.zeros((n, len(every) - n if others is not None else n), np.float32)
    for start in range(0, int(codes[-1]) + 1 if len(codes) else 0, COLUMNS):
        a, b = np.searchsorted(codes, [start, start + COLUMNS])
        part = np.zeros((len(every), min(COLUMNS, int(codes[-1]) + 1 - start)), np.float32)
        part[rows[a:b], codes[a:b] - start] = 1
        top += part[:n] @ (part[n:] if others is not None else part).T
    # top / (a + b - top) >= p / q, in whole numbers
    p, q = THRESHOLD
    own, other = sizes[:n, None], (sizes[n:] if others is not None else sizes)[None, :]
    links = (p + q) * top >= p * (own + other)
    if others is None:
        np.fill_diagonal(links, False)
    return links


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a symmetric matrix of links."""
    n, seen, edges = len(links), np.zeros(len(links), bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            node = front.pop()
            fresh = np.flatnonzero(links[node] & ~seen)
            seen[fresh] = True
            edges += [(node, one) for one in fresh.tolist()]
            front += fresh.tolist()
    return edges


_VERIFIED_DDL = "key binary, links long, other binary"
_VERIFIED = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("other", pa.binary())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per unit (two blocks of a cluster, or one with itself): link counts and a forest."""
    for unit in groups_of(batches, "unit"):
        keys = unit.column("key").to_pylist()
        copies = unit.column("copies").to_numpy()
        side = unit.column("side").to_numpy()
        sets = [np.frombuffer(one, np.uint64) for one in unit.column("grams").to_pylist()]
        # a class may come more than once if the very same document does
        first = {key: i for i, key in reversed(list(enumerate(keys)))}
        left = [i for key, i in first.items() if side[i] == 0]
        right = [i for key, i in first.items() if side[i] == 1]
        if unit.column("twin")[0].as_py():
            links = linked([sets[i] for i in left], None)
            whole, members = links, left
            counts = links @ copies[left]
        else:
            if not left or not right:
                continue
            links = linked([sets[i] for i in left], [sets[i] for i in right])
            counts = np.concatenate([links @ copies[right], links.T @ copies[left]])
            members = left + right
            whole = np.zeros((len(members), len(members)), bool)
            whole[: len(left), len(left) :] = links
            whole[len(left) :, : len(left)] = links.T
        some = np.flatnonzero(counts)
        edges = forest(whole) if len(some) else []
        names = [keys[members[i]] for i in some.tolist()] + [keys[members[a]] for a, _ in edges]
        others = [None] * len(some) + [keys[members[b]] for _, b in edges]
        numbers = np.concatenate([counts[some], np.zeros(len(edges), np.int64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(numbers), pa.array(others, pa.binary())], schema=_VERIFIED
        )


def verified(docs: DataFrame, classes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Links per class (key, links) and edges between classes (key, other), on full sets."""
    members = clusters.select(F.col("node").alias("key"), "component").join(
        classes.select("key", "rep", "copies", "n_shingles"), "key"
    )
    sizes = members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.lit(1)
        ).alias("blocks")
    )
    dealt = members.join(sizes, "component").select(
        F.col("key").alias("member"),
        "rep",
        "copies",
        "component",
        "blocks",
        F.pmod(F.xxhash64("key"), "blocks").alias("block"),
    )
    texts = has_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key")
    )
    # one document per class: the one with its smallest doc_id
    same = (F.col("text_key") == F.col("member")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    found = texts.join(dealt, same).select("member", "component", "blocks", "block", "copies", "text")
    schema = "member binary, component binary, blocks long, block long, copies long, grams binary"
    sets = found.mapInArrow(releasing(_sets), schema)
    paired = sets.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    units = paired.select(
        F.concat("component", F.encode(F.concat_ws(",", F.lit(""), low, high), "utf-8")).alias("unit"),
        (low == high).alias("twin"),
        F.when(F.col("block") == low, 0).otherwise(1).alias("side"),
        F.col("member").alias("key"),
        "copies",
        "grams",
    )
    n = shuffle_partitions(docs.sparkSession)
    return units.repartition(n, "unit").sortWithinPartitions("unit", "key").mapInArrow(releasing(_verify), _VERIFIED_DDL)


# -- the join ------------------------------------------------------------------------


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its group), copy_id
    (the smallest doc_id with the same text), n_copies (documents with that text), n_links
    (other documents at the threshold or over it), text_key, group_key (one for all
    documents of a group).
    """
    signed = cut(signed_documents(docs))
    classes = cut(
        signed.groupBy("key").agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        )
    )
    clusters = components(candidate_edges(classes))
    checked = cut(verified(docs, classes, clusters))
    links = checked.where(F.col("other").isNull()).groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(checked.where(F.col("other").isNotNull()).select(F.col("key").alias("a"), F.col("other").alias("b")))
    named = groups.join(classes.select(F.col("key").alias("node"), "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    class_of = groups.join(smallest, "component").select(F.col("node").alias("key"), "class_id", "component")
    facts = (
        classes.select("key", "rep", "copies", "n_shingles")
        .join(links, "key", "left")
        .join(class_of, "key", "left")
        .select(
            F.col("key").alias("text_key"),
            "rep",
            "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("class_id", "rep").alias("class_id"),
            F.coalesce("component", "key").alias("group_key"),
            (F.col("n_shingles") > 0).alias("has_words"),
        )
    )
    joined = signed.select("doc_id", F.col("key").alias("text_key")).join(facts, "text_key")
    return joined.select(
        "doc_id",
        F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("has_words"), F.col("rep")).otherwise(F.col("doc_id")).alias("copy_id"),
        F.when(F.col("has_words"), F.col("copies")).otherwise(F.lit(1)).alias("n_copies"),
        F.when(F.col("has_words"), F.col("n_links")).otherwise(F.lit(0)).alias("n_links"),
        "text_key",
        "group_key",
    )


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group; documents without words stay.

    Of several texts with that doc_id the one with the smallest key stays, and of rows with
    the same text one.
    """
    found = similar_documents(docs)
    mine = F.col("doc_id").eqNullSafe(F.col("class_id"))
    winners = (
        found.where(mine)
        .groupBy("doc_id", "text_key")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("group_key").alias("group_key"))
        # texts without words are groups of their own, in each doc_id
        .groupBy("doc_id", "group_key")
        .agg(F.min(F.struct("text_key", "rows")).alias("one"))
        .select(F.col("doc_id").alias("__doc_id"), F.col("one.text_key").alias("__text_key"), F.col("one.rows").alias("__rows"))
    )
    key, rows = free_name(docs, "__key"), free_name(docs, "__rows")
    doc_id, text_key = free_name(docs, "__doc_id"), free_name(docs, "__text_key")
    named = winners.withColumnsRenamed({"__doc_id": doc_id, "__text_key": text_key, "__rows": rows})
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    same = (F.col(key) == F.col(text_key)) & docs["doc_id"].eqNullSafe(F.col(doc_id))
    kept = keyed.join(named, same)
    single = kept.where(F.col(rows) == 1)
    again = kept.where(F.col(rows) > 1).dropDuplicates([doc_id, key])
    return single.unionByName(again).select(*[F.col(name) for name in docs.columns])
