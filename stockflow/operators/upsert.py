"""Insert or replace rows by key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``source``, and the rows of ``target`` with other keys."""
    return target.join(source, keys, "left_anti").unionByName(source)
