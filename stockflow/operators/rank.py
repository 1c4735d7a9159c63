"""Rank over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.session import scratch_path

_SLOT = "__slot"
_PART = "__part"
_BEFORE = "__before"
_ROW_BITS = 33  # monotonically_increasing_id: row number in the lower 33 bits


def global_rank(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``, the 1-based position in ``order``, which must be total.

    Rows are range partitioned and sorted, numbered inside their partition, and
    written once to the shared folder: range bounds come from a sample, so the two
    reads below must see the same partitions, also after the loss of an executor.
    The only row set broadcast is one row per range partition. The write is a job of its
    own that runs when this is called, not when the result is read; a refresh removes the
    copies of its ranks at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "rank")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .write.option("compression", "zstd").parquet(path)
    )
    ranged = spark.read.parquet(path).withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(_PART, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    row = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        ranged.join(F.broadcast(offsets), _PART)
        .withColumn(out, F.col(_BEFORE) + row)
        .select(out, *df.columns)
    )
