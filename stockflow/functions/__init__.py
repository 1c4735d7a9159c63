"""Column functions with the null-on-error rules the models rely on."""

from stockflow.functions.casts import (
    MONEY,
    safe_bool,
    safe_divide,
    safe_long,
    safe_money,
    safe_ts,
)
from stockflow.functions.dates import days_before, days_between, local_date, utc_date
from stockflow.functions.json import json_list, parse_payload
from stockflow.functions.text import extract_first, has_tag, trim_blanks

__all__ = [
    "MONEY",
    "days_before",
    "days_between",
    "extract_first",
    "has_tag",
    "json_list",
    "local_date",
    "parse_payload",
    "safe_bool",
    "safe_divide",
    "safe_long",
    "safe_money",
    "safe_ts",
    "trim_blanks",
    "utc_date",
]
