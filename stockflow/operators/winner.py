"""The single best row of each group, if there is a single one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "__row"
_NEXT = "__next"


def unique_winner(
    df: DataFrame, keys: list[str], measure: str, tiebreak: list[Column]
) -> DataFrame:
    """Rows with the highest ``measure`` of their group, unless two rows share it.

    Two rows per group decide this: the best and the runner-up. All others are
    dropped before the shuffle, so a very large group does not reach one task.
    ``tiebreak`` only makes the order of the top two repeatable.
    """
    best_first = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), *tiebreak)
    top_two = (
        df.where(F.col(measure).isNotNull())
        .withColumn(_ROW, F.row_number().over(best_first))
        .where(F.col(_ROW) <= 2)
    )
    runner_up = F.lead(measure).over(best_first)
    return (
        top_two.withColumn(_NEXT, runner_up)
        .where((F.col(_ROW) == 1) & (F.col(_NEXT).isNull() | (F.col(_NEXT) < F.col(measure))))
        .drop(_ROW, _NEXT)
    )
