"""Units sold over several look-back windows in one pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.dates import days_before


def windowed_units(
    df: DataFrame,
    keys: list[str],
    ts: str,
    quantity: str,
    as_of: datetime,
    days: dict[str, int],
) -> DataFrame:
    """Group by ``keys``: one sum per entry of ``days`` (column name to number of
    days before ``as_of``), and the first and last ``ts`` over all rows.

    All are sums, minima and maxima: Spark combines them before the shuffle, and
    the result can be grouped further with :func:`regroup_units`.
    """
    sums = [
        F.sum(F.when(F.col(ts) >= days_before(as_of, n), F.col(quantity)).otherwise(F.lit(0))).alias(name)
        for name, n in days.items()
    ]
    return df.groupBy(*keys).agg(*sums, F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))


def regroup_units(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Combine groups of :func:`windowed_units` into coarser ones."""
    return df.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in sums],
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
