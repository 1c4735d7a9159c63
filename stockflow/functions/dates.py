"""Dates of UTC instants, in UTC or in a named zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: datetime) -> Column:
    """A literal UTC instant; the session time zone is UTC."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def days_before(value: datetime, days: int) -> Column:
    # worked out on the driver: a literal is pushed down to the file scan
    return instant(value - timedelta(days=days))


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def utc_date(ts: Column) -> Column:
    return F.to_date(ts)


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier).cast("bigint")
