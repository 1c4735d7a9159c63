"""The pair rules as lanes, against the same rules for one pair at a time."""

import itertools
from dataclasses import replace
from datetime import datetime

import pytest

from stockflow.config import RetailConfig
from stockflow.plans import rotation

PLACES = [
    "Online / Warehouse",
    "Flinders Lane",
    "Fitzroy",
    "Newtown",
    "Smith St",
    "Claremont",
    "Paddington",
    "Oxford St",
    "Wellington",
    "James St",
    "Popup",
    None,
]
CFG = RetailConfig(as_of=datetime(2026, 7, 1))
DEMAND_COLUMNS = (
    "location_id long, location_name string, product_id long, variant_id long, inventory_item_id long, "
    "product_title string, variant_title string, sku string, product_type string, available_quantity long, "
    "style_units_sold_12_weeks long, style_demand_score double, warehouse_available_quantity long"
)


def demand_row(place, variant, quantity, score, product=None, kind="Knit", warehouse=0, location=None):
    location = PLACES.index(place) if location is None else location
    product = variant if product is None else product
    return (
        location, place, product, variant, variant + 1_000_000, f"Style {product}", "M", f"S{variant}", kind,
        quantity, int(score * 12), float(score), warehouse,
    )


def tables(spark, demand, flags=None, places=None):
    demand_df = spark.createDataFrame(demand, DEMAND_COLUMNS)
    if places is None:
        places = list(enumerate(PLACES))
    locations = spark.createDataFrame(places, "location_id long, location_name string")
    products = {row[2] for row in demand}
    flag_rows = [(p, True, False, False, (flags or {}).get(p, False)) for p in sorted(products)]
    return {
        "variant_location_demand": demand_df,
        "store_rotation_locations": rotation.store_rotation_locations({"dim_locations": locations}, CFG),
        "store_rotation_products": spark.createDataFrame(
            flag_rows,
            "product_id long, is_season_aw26 boolean, is_aw26_rotation_excluded boolean, is_sock boolean, "
            "is_classics boolean",
        ),
    }


CLOSED_PAIR = {"Oxford St": "Newtown", "Newtown": "Oxford St"}
CAREFUL_SENDERS = {"Flinders Lane", "Fitzroy"}


def may_move(sender, receiver, classics):
    """The rules, written for one pair of rows instead of as lanes."""
    s, r = sender[1], receiver[1]
    s_units, r_units, wanted_more = sender[9], receiver[9], receiver[11] > sender[11]
    if s is None or r is None or s in CFG.never_send or r in CFG.never_receive:
        return False
    if s_units <= 0 or r_units >= 2 or sender[12] > 0 or receiver[12] > 0:
        return False
    if s in CLOSED_PAIR or r in CLOSED_PAIR:
        if CLOSED_PAIR.get(s) != r or r_units != 0:
            return False
        return s == "Oxford St" or (s_units >= 2 and wanted_more)
    if r == "Smith St" and not classics and "DENIM" not in receiver[8].upper():
        return False
    if s in CAREFUL_SENDERS:
        allowed = (CAREFUL_SENDERS - {s}) | {"Smith St"}
        return r in allowed and s_units > 2 and r_units == 0 and wanted_more
    return True


def units_to_move(sender, receiver):
    if receiver[1] in ("Oxford St", "Newtown"):
        return 1
    if receiver[9] <= 0:
        return min(sender[9], 2)
    return 1 if receiver[9] == 1 else 0


def test_every_lane_with_every_quantity_and_demand(spark):
    """One variant per case: all pairs of places, stock levels, demands and kinds."""
    demand, classics = [], {}
    cases = itertools.product(
        itertools.permutations(PLACES, 2), (0, 1, 2, 3), (-1, 0, 1, 2), (0.0, 1.0), ("plain", "denim", "classics")
    )
    for variant, ((s, r), s_units, r_units, r_score, kind) in enumerate(cases, start=1):
        product_type = "Blue Denim" if kind == "denim" else "Knit"
        classics[variant] = kind == "classics"
        demand.append(demand_row(s, variant, s_units, 0.5, kind=product_type))
        demand.append(demand_row(r, variant, r_units, r_score, kind=product_type))
    found = rotation.store_rotation_candidates(tables(spark, demand, classics), CFG).collect()
    by_variant = {}
    for row in demand:
        by_variant.setdefault(row[3], []).append(row)
    expected = {
        (variant, s[0], r[0], units_to_move(s, r), r[11] * 20 - s[11] * 5)
        for variant, pair in by_variant.items()
        for s, r in itertools.permutations(pair, 2)
        if may_move(s, r, classics[variant])
    }
    assert len(expected) > 500
    assert {
        (
            row.variant_id,
            row.send_from_location_id,
            row.send_to_location_id,
            row.recommended_transfer_quantity,
            row.rotation_score - row.send_to_rotation_priority - 75,
        )
        for row in found
    } == expected
    assert len(found) == len(expected)
    lanes = {(row.send_from_location_name, row.send_to_location_name) for row in found}
    assert ("Fitzroy", "Smith St") in lanes and ("Newtown", "Oxford St") in lanes


def test_ranks_of_donors_and_receivers(spark):
    demand = [
        demand_row("Claremont", 1, 5, 0.0),
        demand_row("Wellington", 1, 5, 1.0),
        demand_row("Fitzroy", 1, 0, 2.0),
        demand_row("Flinders Lane", 1, 1, 9.0),
    ]
    found = rotation.store_rotation_candidates(tables(spark, demand), CFG).collect()
    ranks = {
        (r.send_from_location_name, r.send_to_location_name): (r.donor_tier, r.candidate_rank, r.donor_rank)
        for r in found
    }
    assert ranks == {
        # lower sender demand gives the higher score, so Claremont gives first
        ("Claremont", "Fitzroy"): (3, 1, 1),
        ("Wellington", "Fitzroy"): (3, 2, 1),
        # the empty shelf goes first, whatever the score
        ("Claremont", "Flinders Lane"): (3, 1, 2),
        ("Wellington", "Flinders Lane"): (3, 2, 2),
    }


def test_stock_at_the_warehouse_stops_rotation(spark):
    demand = [demand_row("Claremont", 1, 5, 0.0, warehouse=1), demand_row("Fitzroy", 1, 0, 2.0, warehouse=1)]
    assert rotation.store_rotation_candidates(tables(spark, demand), CFG).count() == 0


@pytest.mark.parametrize(
    ("fitzroy", "flinders", "expected"), [(3, 2, ["Fitzroy"]), (3, 3, []), (2, 3, ["Flinders Lane"]), (1, 0, [])]
)
def test_consolidation_needs_a_single_best_destination(spark, fitzroy, flinders, expected):
    demand = [
        demand_row("Online / Warehouse", 1, 0, 0),
        demand_row("Claremont", 1, 1, 0),
        demand_row("Fitzroy", 1, fitzroy, 0),
        demand_row("Flinders Lane", 1, flinders, 0),
    ]
    found = rotation.style_consolidation_candidates(tables(spark, demand), CFG).collect()
    assert [row.send_to_location_name for row in found] == expected
    assert all(row.highest_destination_count == 1 and row.recommended_transfer_quantity == 1 for row in found)


def test_consolidation_of_styles(spark):
    def style(product, *stock, warehouse=0):
        base = [demand_row("Online / Warehouse", product * 10, warehouse, 0, product)] if warehouse is not None else []
        return base + [demand_row(place, product * 10 + n, units, 0, product) for place, n, units in stock]

    demand = [
        # +2 and -1 make one unit of the style: the variant in stock moves
        *style(1, ("Claremont", 0, 2), ("Claremont", 1, -1), ("Fitzroy", 0, 4)),
        # +1, +1 and -1 also make one, but two variants could move
        *style(2, ("Claremont", 0, 1), ("Claremont", 1, 1), ("Claremont", 2, -1), ("Fitzroy", 0, 4)),
        # without a warehouse row nothing moves
        *style(3, ("Claremont", 0, 1), ("Fitzroy", 0, 4), warehouse=None),
        # Smith St takes no knits
        *style(4, ("Claremont", 0, 1), ("Smith St", 0, 9), ("Fitzroy", 0, 2)),
        # Newtown only gives to Oxford St
        *style(5, ("Newtown", 0, 1), ("Fitzroy", 0, 9), ("Oxford St", 0, 2)),
        # stock at the warehouse
        *style(6, ("Claremont", 0, 1), ("Fitzroy", 0, 4), warehouse=1),
    ]
    found = rotation.style_consolidation_candidates(tables(spark, demand), CFG).collect()
    assert sorted((r.product_id, r.variant_id, r.send_from_location_name, r.send_to_location_name) for r in found) == [
        (1, 10, "Claremont", "Fitzroy"),
        (4, 40, "Claremont", "Fitzroy"),
        (5, 50, "Newtown", "Oxford St"),
    ]


def test_smith_st_gives_to_open_locations_once_it_may_send(spark):
    cfg = replace(CFG, never_send=("Online / Warehouse",))
    demand = [
        *[demand_row("Online / Warehouse", v, 0, 0, 1) for v in (10,)],
        demand_row("Smith St", 11, 1, 0, 1),
        demand_row("Fitzroy", 12, 4, 0, 1),
        demand_row("Newtown", 13, 9, 0, 1),
    ]
    given = tables(spark, demand)
    locations = spark.createDataFrame(list(enumerate(PLACES)), "location_id long, location_name string")
    given["store_rotation_locations"] = rotation.store_rotation_locations({"dim_locations": locations}, cfg)
    found = rotation.style_consolidation_candidates(given, cfg).collect()
    assert [(r.send_from_location_name, r.send_to_location_name) for r in found] == [("Smith St", "Fitzroy")]
