"""Pivot over a fixed list of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_fixed(
    df: DataFrame,
    key: str,
    name_col: str,
    names: tuple[tuple[str, str], ...],
    measures: dict[str, str],
) -> DataFrame:
    """One row per ``key``, one column ``prefix_suffix`` per name and measure.

    ``names`` holds (value, column prefix) pairs, ``measures`` maps suffix to column.
    A single aggregation of conditional maxima, combined before the shuffle.
    """
    cells = [
        F.max(F.when(F.col(name_col) == value, F.col(measure))).alias(f"{prefix}_{suffix}")
        for suffix, measure in measures.items()
        for value, prefix in names
    ]
    return df.groupBy(key).agg(*cells)


def pick_by_name(name: Column, names: tuple[tuple[str, str], ...], suffix: str) -> Column:
    """The pivot cell of the named location, NULL for a name outside the list."""
    return F.coalesce(*[F.when(name == value, F.col(f"{prefix}_{suffix}")) for value, prefix in names])
