"""Reusable DataFrame operators."""

from stockflow.operators.arrays import explode_json_array
from stockflow.operators.latest import latest_by, latest_of_elements, latest_of_wide
from stockflow.operators.pairs import lane_group, pair_within
from stockflow.operators.pivot import pivot_fixed
from stockflow.operators.quality import check_not_null, check_unique
from stockflow.operators.rank import global_rank
from stockflow.operators.units import windowed_units
from stockflow.operators.upsert import upsert
from stockflow.operators.winner import unique_winner

__all__ = [
    "check_not_null",
    "check_unique",
    "explode_json_array",
    "global_rank",
    "lane_group",
    "latest_by",
    "latest_of_elements",
    "latest_of_wide",
    "pair_within",
    "pivot_fixed",
    "unique_winner",
    "upsert",
    "windowed_units",
]
