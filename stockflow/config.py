"""Business settings of the models: names, rules and dates as data.

Every model takes a ``RetailConfig``. Nothing below reads the clock: "now" is
``as_of``, so that a run can be repeated and compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# ---------------------------------------------------------------------------
# They must equal the published ones for the results to be right.
# ---------------------------------------------------------------------------

# (name used in sales tags, name used by the stock system)
SALES_LOCATION_NAMES = (
    ("Warehouse", "Online / Warehouse"),
    ("Melbourne", "Flinders Lane"),
    ("Fitzroy", "Fitzroy"),
    ("Newtown", "Newtown"),
    ("Smith St", "Smith St"),
    ("Melbourne Outlet", "Melbourne Outlet"),
    ("Claremont", "Claremont"),
    ("Paddington", "Paddington"),
    ("Oxford St", "Oxford St"),
    ("Wellington", "Wellington"),
    ("James St", "James St"),
    ("Spring1883", "Spring1883"),
)

WAREHOUSE = "Online / Warehouse"

INTERNAL_LOCATIONS = ("Faulty Land", "Sparehouse")

NEVER_SEND = (
    "Online / Warehouse",
    "Faulty Land",
    "Sparehouse",
    "Melbourne Outlet",
    "Spring1883",
    "Smith St",
    "Paddington",
)

NEVER_RECEIVE = (
    "Claremont",
    "Wellington",
    "James St",
    "Paddington",
    "Online / Warehouse",
    "Faulty Land",
    "Sparehouse",
    "Melbourne Outlet",
    "Spring1883",
)

RECEIVER_PRIORITY = (
    ("Flinders Lane", 100),
    ("Fitzroy", 95),
    ("Smith St", 90),
    ("Newtown", 85),
    ("Oxford St", 80),
)

DONOR_TIERS = (
    ("Newtown", 1),
    ("Oxford St", 2),
    ("Wellington", 3),
    ("Claremont", 3),
    ("James St", 3),
    ("Flinders Lane", 4),
    ("Fitzroy", 4),
)
LAST_DONOR_TIER = 99

# rotation score = receiver demand * 20 - sender demand * 5 + priority + 75
SCORE_PER_RECEIVER_DEMAND = 20
SCORE_PER_SENDER_DEMAND = 5
SCORE_WAREHOUSE_EMPTY = 75

NEGATIVE_STOCK_LOCATIONS = (
    "Claremont",
    "Fitzroy",
    "Flinders Lane",
    "James St",
    "Newtown",
    "Oxford St",
    "Online / Warehouse",
    "Smith St",
)

# (location, column prefix) of the workbench pivot
WORKBENCH_LOCATIONS = (
    ("Oxford St", "oxford_st"),
    ("Newtown", "newtown"),
    ("Fitzroy", "fitzroy"),
    ("Flinders Lane", "flinders_lane"),
    ("James St", "james_st"),
    ("Claremont", "claremont"),
    ("Wellington", "wellington"),
    ("Paddington", "paddington"),
)

SEASON_TAG = "SEASON_AW26"
# \z, not $: Java's $ also matches before a closing line break.
SEASON_PATTERN = r"(^|,\s*)season_aw26(\s*,|\z)"
ROTATION_EXCLUDED_PATTERN = r"(^|,\s*)aw26 rotation"
CLASSICS_PATTERN = r"(^|,\s*)classics(\s*,|\z)"
SOCK_PATTERN = r"\bsocks?\b"
ORDER_LOCATION_PATTERN = r"Location ([^,]+)"
DENIM = "DENIM"

TRADING_ZONE = "Australia/Melbourne"
WEEKS_IN_30_DAYS = 4.2857
LOW_COVER_WEEKS = 2
OVERSTOCK_WEEKS = 12

RECOMMENDATION_REASON = (
    "Move {units} unit from {sender} to {receiver}. Warehouse has {warehouse_units} units remaining."
)
REPORT_REASON = (
    "Move {units} unit from {sender} to {receiver}. "
    "{receiver} has {receiver_units} units and sold {receiver_sales} style units in 12 weeks. "
    "{sender} has {sender_units} units and sold {sender_sales} style units. "
    "Warehouse has {warehouse_units} units."
)

ROTATION_TYPE = "rotation_recommendation_warehouse_empty"
CONSOLIDATION_TYPE = "style_consolidation"

# ---------------------------------------------------------------------------
# Lanes: which location may send to which. A location without rules of its own
# belongs to the lane group OPEN; every other group is one location name.
# ---------------------------------------------------------------------------

OPEN = "(open)"


@dataclass(frozen=True)
class Lane:
    """One permitted direction of stock and the conditions on it."""

    sender: str
    receiver: str
    least_sender_units: int = 1
    receiver_must_be_empty: bool = False
    needs_higher_demand: bool = False
    denim_or_classics_only: bool = False


ROTATION_LANES = (
    Lane("Newtown", "Oxford St", least_sender_units=2,
         receiver_must_be_empty=True, needs_higher_demand=True),
    Lane("Oxford St", "Newtown", receiver_must_be_empty=True),
    Lane("Flinders Lane", "Fitzroy", least_sender_units=3,
         receiver_must_be_empty=True, needs_higher_demand=True),
    Lane("Flinders Lane", "Smith St", least_sender_units=3,
         receiver_must_be_empty=True, needs_higher_demand=True,
         denim_or_classics_only=True),
    Lane("Fitzroy", "Flinders Lane", least_sender_units=3,
         receiver_must_be_empty=True, needs_higher_demand=True),
    Lane("Fitzroy", "Smith St", least_sender_units=3,
         receiver_must_be_empty=True, needs_higher_demand=True,
         denim_or_classics_only=True),
    Lane("Smith St", "Flinders Lane"),
    Lane("Smith St", "Fitzroy"),
    Lane("Smith St", "Smith St", denim_or_classics_only=True),
    Lane("Smith St", OPEN),
    Lane(OPEN, "Flinders Lane"),
    Lane(OPEN, "Fitzroy"),
    Lane(OPEN, "Smith St", denim_or_classics_only=True),
    Lane(OPEN, OPEN),
)

CONSOLIDATION_LANES = (
    Lane("Newtown", "Oxford St"),
    Lane("Oxford St", "Newtown"),
    Lane("Smith St", "Smith St", denim_or_classics_only=True),
    Lane("Smith St", OPEN),
    Lane(OPEN, "Smith St", denim_or_classics_only=True),
    Lane(OPEN, OPEN),
)

# These two always receive exactly one unit.
SINGLE_UNIT_RECEIVERS = ("Oxford St", "Newtown")
# These two never give up their last unit of a style.
CONSOLIDATION_NEVER_SEND = ("Fitzroy", "Flinders Lane")


@dataclass(frozen=True)
class RetailConfig:
    """Settings of one run. ``as_of`` is a UTC instant without zone."""

    as_of: datetime
    trading_zone: str = TRADING_ZONE
    warehouse: str = WAREHOUSE
    sales_location_names: tuple = SALES_LOCATION_NAMES
    internal_locations: tuple = INTERNAL_LOCATIONS
    never_send: tuple = NEVER_SEND
    never_receive: tuple = NEVER_RECEIVE
    receiver_priority: tuple = RECEIVER_PRIORITY
    donor_tiers: tuple = DONOR_TIERS
    negative_stock_locations: tuple = NEGATIVE_STOCK_LOCATIONS
    workbench_locations: tuple = WORKBENCH_LOCATIONS
    rotation_lanes: tuple = ROTATION_LANES
    consolidation_lanes: tuple = CONSOLIDATION_LANES
    single_unit_receivers: tuple = SINGLE_UNIT_RECEIVERS
    consolidation_never_send: tuple = CONSOLIDATION_NEVER_SEND
    season_tag: str = SEASON_TAG
    season_pattern: str = SEASON_PATTERN
    rotation_excluded_pattern: str = ROTATION_EXCLUDED_PATTERN
    classics_pattern: str = CLASSICS_PATTERN
    sock_pattern: str = SOCK_PATTERN
    order_location_pattern: str = ORDER_LOCATION_PATTERN
