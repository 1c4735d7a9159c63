"""Connected components of a graph given as pairs, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has columns a and b; the result has (node, component), the component being
    its smallest node. Nodes without an edge are not listed; NULL ends are ignored.

    Alternates the large-star and the small-star step: each node points its larger, then
    its smaller neighbours to the smallest one. The number of rounds grows with the
    logarithm of the graph's size. The smallest neighbour is found by an aggregation that
    combines before it shuffles, and joined back, so a hub's rows can be split.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = cut(pairs.where((F.col("a") != F.col("b"))).distinct())
    state = _state(pairs)
    while state[0]:
        pairs = cut(_small_star(_large_star(pairs)))
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select("v", "v").distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    """Changes when the pairs change."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        pairs.agg(
            F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed.bitwiseAND(F.lit((1 << 31) - 1)))
        ).first()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of node and neighbours."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least, "u")
    # the row of the smallest neighbour itself becomes the node's own
    moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return joined.select(moved.alias("u"), F.col("m").alias("v")).distinct()
