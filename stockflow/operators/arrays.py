"""One row per element of a JSON array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.json import json_list


def explode_json_array(
    df: DataFrame, payload: str, field: str, out: str, outer: bool = False
) -> DataFrame:
    """Add ``out``, the JSON text of one element. Rows whose array is missing or
    empty are dropped, or kept with a NULL element when ``outer``."""
    spread = F.explode_outer if outer else F.explode
    return df.withColumn(out, spread(json_list(F.col(payload), field)))
