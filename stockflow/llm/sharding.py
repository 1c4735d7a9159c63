"""Proportional stratified interleaving: shards that all match the mixture of sources.

The rows of each source are put in a seeded random order and numbered. A row's place
in the whole is its number as a fraction of its source's rows, so every stretch of the
whole order holds the sources in their proportions. Cut into equal stretches, that gives
shards whose row counts differ by one at most (the law ``rows``).

Both numberings count rows per (group, bucket) first and number rows only inside a
bucket. Buckets come from a hash or a fraction, so a source with a third of all rows is
spread over as many tasks as any other.

Defined cases: a NULL source is a source of its own; a NULL text has no bytes (size 1)
and the checksum of no bytes (0); rows that are equal in every column used are numbered
in any order, which gives the same result; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockflow.llm.common import cut, free_name, has_columns

SHARDS = 16
SEED = "mix-1"
# hash digits that name a bucket of a source, and stretches of the whole order
SOURCE_DIGITS = 3
STRETCHES = 4096


def _place_of_source() -> F.Column:
    """Where between two numbers a source puts its rows: 0 to under 1, fixed per source.

    Sources with one row each would otherwise all sit in the middle.
    """
    digits = F.substring(F.md5(F.concat(F.lit("source:"), F.coalesce("source", F.lit("")))), 1, 6)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**6))


def keyed_rows(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and checksum of the text, and the seeded order key."""
    text = F.coalesce("text", F.lit(""))
    rows = has_columns(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32"))
    return rows.withColumn("order_key", key)


def rank_in_source(rows: DataFrame) -> DataFrame:
    """Add ``in_source`` (from 0, in seeded order) and ``of_source`` (rows of the source)."""
    rows = rows.withColumn("bucket", F.substring("order_key", 1, SOURCE_DIGITS)).withColumn(
        "group", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    )
    counts = rows.groupBy("group", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # a source has a bounded number of buckets, so this window is small
    of_group = Window.partitionBy("group")
    earlier = of_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "group",
        "bucket",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
        F.sum("n").over(of_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(
            "of_source"
        ),
    )
    inside = Window.partitionBy("group", "bucket").orderBy("order_key", "doc_id", "text_crc32", "size")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(bases, ["group", "bucket"]).withColumn("in_source", F.col("base") + F.col("inside"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    ranked = rank_in_source(cut(keyed_rows(docs, seed)))
    fraction = (F.col("in_source") + _place_of_source()) / F.col("of_source")
    placed = cut(
        ranked.select("doc_id", "source", "size", "text_crc32", "order_key", fraction.alias("fraction")).withColumn(
            "stretch", F.floor(F.col("fraction") * STRETCHES).cast("int")
        )
    )
    counts = placed.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))
    # at most STRETCHES rows: the only window that one task sees whole
    whole = Window.orderBy("stretch")
    bases = counts.select(
        "stretch",
        F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy("stretch").orderBy("fraction", "source", "order_key", "doc_id", "text_crc32", "size")
    positions = (
        placed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(bases, "stretch")
        .withColumn("position", (F.col("base") + F.col("inside")).cast("long"))
    )
    shard = F.expr(f"position * {shards} div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return positions.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _copies(rows: DataFrame, doc_id: str, crc: str, number: str, order: list[str]) -> DataFrame:
    """Numbers the rows of one doc_id and text."""
    return rows.withColumn(number, F.row_number().over(Window.partitionBy(doc_id, crc).orderBy(*order)))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED) -> None:
    """Write whole documents as Parquet, one folder per shard, in slot order.

    Each row is written once, repeated rows too: the copies of one doc_id and text meet their
    slots by number. The files' columns ``shard`` and ``slot`` are the shard's; columns of
    these names in ``docs`` are replaced. A shard is written by several tasks: slots are cut
    into ranges, so no task holds a whole shard.
    """
    own = docs.drop(*[name for name in docs.columns if name.lower() in ("shard", "slot")])
    crc, number, doc_id = (free_name(own, f"__{name}") for name in ("crc", "number", "doc_id"))
    places = assign_shards(docs, shards, seed).select(
        F.col("doc_id").alias(doc_id), F.col("text_crc32").alias(crc), "shard", "slot"
    )
    slots = _copies(places, doc_id, crc, number, ["shard", "slot"])
    keyed = own.withColumn(doc_id, F.col("doc_id")).withColumn(crc, F.crc32(F.coalesce("text", F.lit(""))).cast("long"))
    # written, so that a task run again numbers alike copies as before
    numbered = cut(_copies(keyed, doc_id, crc, number, [crc]))
    same = [numbered[doc_id].eqNullSafe(slots[doc_id]), numbered[crc] == slots[crc], numbered[number] == slots[number]]
    joined = numbered.join(slots, same).select(*[numbered[name] for name in own.columns], slots["shard"], slots["slot"])
    (
        joined.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
