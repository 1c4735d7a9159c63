"""How far apart the sources of a language are, term by term and pair by pair.

1. Words are counted per (lang, source, term) inside the tasks, over slices of whole texts, and
   added up by Spark. Terms in MIN_DOCS documents of their language or more are kept.
2. Each group (lang, source) gives each kept term a smoothed share in billionths, a whole number
   that depends on the group and the term's count there, its level, only. Decimals of 38 digits
   keep it exact.
3. For pairs, terms are cut into blocks by a hash, and groups into tiles. In a block, a column of
   ones marks the terms at a (group, level). The product of these columns, transposed, with those
   of another tile is the joint table: how many terms have level c in one group and level d in
   the other. Each cell is priced with the difference of the two shares, once per pair of levels,
   and Spark adds the prices up. Products are of zeros and ones, at most BLOCK_TERMS in a sum, so
   32-bit floats hold them exactly.
4. Terms that both groups of a pair lack are not sent anywhere: their number follows from V, and
   they share one price.

A unit of work is one block of terms for two tiles of groups: its size does not grow with the data.
The result has a row for every pair of sources of a language, as it must.

Defined cases: NULL text, lang and source count as ''; repeated rows are documents each; a
language without kept terms has pairs of value 0 and no terms; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import cut, groups_of, releasing, ship_package, shuffle_partitions
from stockflow.llm.shingles import text_slices
from stockflow.llm.word_bytes import LETTERS, LOWER, runs_of

MIN_DOCS = 30
TOP_TERMS = 50
BILLION = 1_000_000_000
ADDED_COUNT = 5
BLOCK_TERMS = 64
TILE_GROUPS = 32
SLICE_BYTES = 2 << 20
HELD_ROWS = 1_000_000  # of a task's counts, before they are handed on

GROUP = ["lang", "source"]
_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())]
)


def _slice_counts(langs: pa.Array, sources: pa.Array, data: np.ndarray, edges: np.ndarray) -> pa.Table:
    """Occurrences and documents per group and term of some texts; a row without a term per group."""
    distinct, codes, offsets = runs_of(LOWER[data], edges, LETTERS)
    pairs = pa.table({"lang": langs, "source": sources, "text": np.arange(len(langs))})
    groups = pairs.group_by(["lang", "source"]).aggregate([("text", "list")])
    group_of = np.empty(len(langs), np.int64)
    members = groups.column("text_list").combine_chunks()
    group_of[members.flatten().to_numpy()] = np.repeat(np.arange(len(members)), np.diff(members.offsets.to_numpy()))
    size = max(1, len(distinct))
    text = np.repeat(np.arange(len(langs)), np.diff(offsets))
    in_text, n = np.unique(text * size + codes, return_counts=True)
    cells = group_of[in_text // size] * size + in_text % size
    cell, place = np.unique(cells, return_inverse=True)
    group, term = cell // size, cell % size
    whole = np.concatenate([group, np.arange(len(members))])
    names = pa.concat_arrays([distinct.cast(pa.large_string()).cast(pa.string()).take(pa.array(term)), pa.nulls(len(members), pa.string())])
    zero = np.zeros(len(members), np.int64)
    return pa.Table.from_arrays(
        [
            groups.column("lang").combine_chunks().take(pa.array(whole)),
            groups.column("source").combine_chunks().take(pa.array(whole)),
            names,
            pa.array(np.concatenate([np.bincount(place, n, len(cell)).astype(np.int64), zero])),
            pa.array(np.concatenate([np.bincount(place, minlength=len(cell)), zero])),
        ],
        schema=_COUNTS,
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs; a row with a NULL term for each group."""
    ship_package(docs.sparkSession)

    def merged(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n_docs", "sum")])
        return sums.rename_columns({"n_sum": "n", "n_docs_sum": "n_docs"}).select(_COUNTS.names).cast(_COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            langs, sources, done = *(batch.column(i).fill_null("").cast(pa.string()) for i in (0, 1)), 0
            for data, edges in text_slices(batch.column(2), SLICE_BYTES):
                size = len(edges) - 1
                held.append(_slice_counts(langs.slice(done, size), sources.slice(done, size), data, edges))
                done += size
                rows += held[-1].num_rows
                if rows > HELD_ROWS:
                    held = [merged(held)]
                    rows = held[0].num_rows
                    if 2 * rows > HELD_ROWS:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from merged(held).to_batches()

    read = docs.select(*[docs[name].cast("string") for name in ("lang", "source", "text")])
    partial = read.mapInArrow(releasing(count), "lang string, source string, term string, n long, n_docs long")
    return partial.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _share(count: Column, of_all: Column, n_terms: Column) -> Column:
    """The smoothed share in billionths, rounded down, plus one."""
    top = F.lit(BILLION).cast("decimal(10,0)") * (count + ADDED_COUNT).cast("decimal(27,0)")
    whole = (of_all + n_terms * ADDED_COUNT).cast("decimal(27,0)")
    return F.call_function("div", top, whole) + 1


class Shares:
    """The kept terms of all groups with their shares, written once and read by both parts."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = cut(term_counts(docs))
        terms = counts.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(
            F.sum("n").alias("lang_n"), F.sum("n_docs").alias("lang_docs")
        )
        kept = terms.where(F.col("lang_docs") >= min_docs).select("lang", "term", "lang_n")
        of_terms = cut(counts.join(kept, ["lang", "term"]).select(*GROUP, "term", "n", "lang_n"))
        of_lang = cut(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("of_lang")))
        of_group = of_terms.groupBy(*GROUP).agg(F.sum("n").alias("of_group"))
        nothing = F.lit(0).cast("long")
        # one row per group: every one that occurs, with or without kept terms
        self.groups = cut(
            counts.where(F.col("term").isNull())
            .select(*GROUP)
            .join(of_group, GROUP, "left")
            .join(of_lang, "lang", "left")
            .select(
                *GROUP,
                *[F.coalesce(name, nothing).alias(name) for name in ("of_group", "v", "of_lang")],
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place"),
            )
            .withColumn("p_none", F.when(F.col("v") > 0, _share(nothing, F.col("of_group"), F.col("v"))))
        )
        self.rows = of_terms.join(self.groups, GROUP).withColumn("p", _share(F.col("n"), F.col("of_group"), F.col("v")))

    def top_terms(self, limit: int = TOP_TERMS) -> DataFrame:
        """The terms that a group uses more than its language, most above it first."""
        above = self.rows.withColumn("value", F.col("p") - _share(F.col("lang_n"), F.col("of_lang"), F.col("v")))
        best = Window.partitionBy(*GROUP).orderBy(F.col("value").desc(), F.col("term").asc())
        ranked = above.where((F.col("n") > 0) & (F.col("value") > 0)).withColumn("rank", F.row_number().over(best))
        return ranked.where(F.col("rank") <= limit).select(
            *GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
        )

    def pair_values(self, block_terms: int = BLOCK_TERMS, tile_groups: int = TILE_GROUPS) -> DataFrame:
        """lang, places a < b of two groups, the price of the terms that one of them has, and how many those are."""
        last_tile = F.floor(F.max("place") / tile_groups).cast("int").alias("last_tile")
        tiled = (
            self.groups.where(F.col("v") > 0)
            .join(self.groups.groupBy("lang").agg(last_tile), "lang")
            .withColumn("tile", F.floor(F.col("place") / tile_groups).cast("int"))
            .withColumn("n_blocks", F.greatest(F.floor(F.col("v") / block_terms), F.lit(1)).cast("long"))
            .select(*GROUP, "place", "tile", "last_tile", "n_blocks", "p_none")
        )
        of_terms = self.rows.select(*GROUP, "term", "n", "p").join(tiled, GROUP)
        columns = ["lang", "block", "tile", "last_tile", "place", "term", "n", "p"]
        # every group is in every block of its language, if only with level 0
        everywhere = tiled.select(
            "lang", "tile", "last_tile", "place", F.lit(None).cast("string").alias("term"),
            F.lit(0).cast("long").alias("n"), F.col("p_none").alias("p"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
        )
        rows = of_terms.withColumn("block", F.pmod(F.xxhash64("term"), "n_blocks")).select(*columns)
        # a tile meets every tile of its language, itself included
        units = rows.unionByName(everywhere).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last_tile"))))
        low, high = F.least("tile", "other"), F.greatest("tile", "other")
        named = units.select(
            F.concat_ws("|", F.col("block").cast("string"), low.cast("string"), high.cast("string"), "lang").alias("unit"),
            "lang", low.alias("low"), high.alias("high"), "tile", "place", "term", "n", "p",
        )
        ordered = named.repartition(shuffle_partitions(named.sparkSession), "unit").sortWithinPartitions("unit", "place", "term")
        priced = ordered.mapInArrow(releasing(_price_units), "lang string, a int, b int, value long, covered long")
        return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))

    def pairs(self, **sizes: int) -> DataFrame:
        """Every other source of the language, farthest first."""
        groups = self.groups
        priced = self.pair_values(**sizes)
        both = priced.select("lang", "a", "b", "value", "covered").unionByName(
            priced.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "covered")
        )
        other = groups.select(
            "lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("p_none").alias("other_none")
        )
        # the result itself has a row per pair
        wanted = groups.withColumnRenamed("place", "a").join(other, "lang").where(F.col("a") != F.col("b"))
        none = F.lit(0).cast("long")
        neither = (F.col("v") - F.coalesce("covered", none)) * F.abs(F.col("p_none") - F.col("other_none"))
        value = F.coalesce("value", none) + F.coalesce(neither, none)
        best = Window.partitionBy(*GROUP).orderBy(F.col("value").desc(), F.col("item").asc())
        return (
            wanted.join(both, ["lang", "a", "b"], "left")
            .select(*GROUP, F.lit("pair").alias("part"), "item", value.alias("value"))
            .withColumn("rank", F.row_number().over(best))
        )


def joint_table(levels_a: np.ndarray, n_a: int, levels_b: np.ndarray, n_b: int) -> np.ndarray:
    """How many terms stand at each pair of columns: the product of two one-hot matrices.

    For each term, ``levels_a`` holds the column it marks on one side, and the rows of
    ``levels_b``, one per group, those on the other side.
    """
    terms = np.arange(len(levels_a))
    one, two = np.zeros((n_a, len(terms)), np.float32), np.zeros((len(terms), n_b), np.float32)
    one[levels_a, terms] = 1
    two[terms, levels_b] = 1
    return (one @ two).astype(np.int64)


def _columns_of(place: np.ndarray, term: np.ndarray, n: np.ndarray, p: np.ndarray, n_terms: int):
    """Groups, the column of each (group, term), the price of each column, and where each group's columns begin.

    A group's first column is level 0; ``term`` is -1 in the row that every group has.
    """
    groups, row = np.unique(place, return_inverse=True)
    counts, level = np.unique(n, return_inverse=True)
    cells, first, number = np.unique(row * len(counts) + level, return_index=True, return_inverse=True)
    begins = np.searchsorted(cells, np.arange(len(groups)) * len(counts))
    columns = np.repeat(begins[:, None], n_terms, axis=1)
    there = term >= 0
    columns[row[there], term[there]] = number[there]
    return groups, columns, p[first], begins


def _price_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prices of all pairs of groups of each unit; the rows of a unit follow one another."""
    for unit in groups_of(batches, "unit"):
        lang, low, high = (unit.column(name)[0].as_py() for name in ("lang", "low", "high"))
        place, tile, n, p = (unit.column(name).to_numpy() for name in ("place", "tile", "n", "p"))
        names = unit.column("term").combine_chunks().dictionary_encode()
        n_terms, term = len(names.dictionary), names.indices.fill_null(-1).to_numpy()
        one, two = (
            _columns_of(place[tile == side], term[tile == side], n[tile == side], p[tile == side], n_terms)
            for side in (low, high)
        )
        groups, columns, price, begins = one
        others, other_columns, other_price, other_begins = two
        ends, found = np.append(begins[1:], len(price)), []
        for i, group in enumerate(groups.tolist()):
            # the columns of one group against those of all groups of the other tile
            own = price[begins[i] : ends[i]]
            table = joint_table(columns[i] - begins[i], len(own), other_columns, len(other_price))
            # what both lack is counted over the whole language, not here
            covered = n_terms - table[0, other_begins]
            table[0, other_begins] = 0
            cost = (table * np.abs(own[:, None] - other_price[None, :])).sum(axis=0)
            value, after = np.add.reduceat(cost, other_begins), others > group
            found.append((np.full(int(after.sum()), group), others[after], value[after], covered[after]))
        a, b, value, covered = (np.concatenate(part) for part in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value), pa.array(covered)],
            names=["lang", "a", "b", "value", "covered"],
        )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    shares = Shares(docs, min_docs)
    return shares.pairs().unionByName(shares.top_terms(top_terms))
