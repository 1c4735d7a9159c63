"""Casts that give NULL instead of an error, and the money type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 29 digits before the point, 9 after. Products, sums and differences keep this type
# (``spark.sql.decimalOperations.allowPrecisionLoss`` is off) and are exact; what does
# not fit is an error.
MONEY = T.DecimalType(38, 9)
_UNITS = T.DecimalType(20, 0)


def safe_long(text: Column) -> Column:
    return text.try_cast("bigint")


def safe_money(text: Column) -> Column:
    return text.try_cast(MONEY)


def safe_bool(text: Column) -> Column:
    """Only 'true' and 'false', in any case; Spark's own cast also takes 'yes' or '1'."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def safe_ts(text: Column) -> Column:
    """A full date is required; Spark's own cast also takes '2026' or '12:30'."""
    has_full_date = (F.length(text) >= 8) & (F.substring(text, 5, 1) == "-")
    return F.when(has_full_date, text.try_cast("timestamp"))


def safe_divide(top: Column, bottom: Column) -> Column:
    """Floating point division, NULL for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def money_times_units(price: Column, units: Column) -> Column:
    return (price * units.cast(_UNITS)).cast(MONEY)


def total(amount: Column) -> Column:
    """Sum of money without loss of scale."""
    return F.sum(amount).cast(MONEY)
