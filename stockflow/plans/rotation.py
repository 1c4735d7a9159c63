"""Store-to-store stock rotation and consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.config import (
    CONSOLIDATION_TYPE,
    DENIM,
    LAST_DONOR_TIER,
    RECOMMENDATION_REASON,
    REPORT_REASON,
    ROTATION_TYPE,
    SCORE_PER_RECEIVER_DEMAND,
    SCORE_PER_SENDER_DEMAND,
    SCORE_WAREHOUSE_EMPTY,
    RetailConfig,
)
from stockflow.functions.text import fill, matches
from stockflow.operators import global_rank, pair_within, pivot_fixed, unique_winner
from stockflow.operators.pairs import lane_condition
from stockflow.operators.pivot import pick_by_name
from stockflow.plans.sales import modelled_at
from stockflow.plans.staging import Tables


def _by_name(name: Column, values: tuple, otherwise) -> Column:
    """Value listed for a name in (name, value) pairs."""
    chain = F
    for listed, value in values:
        chain = chain.when(name == listed, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def _not_listed(name: Column, names: tuple) -> Column:
    # a NULL name is on no list
    return ~F.coalesce(name.isin(*names), F.lit(False))


def store_rotation_locations(t: Tables, cfg: RetailConfig) -> DataFrame:
    """May a location send or receive, and how urgently does it receive?"""
    name = F.col("location_name")
    return t["dim_locations"].select(
        "location_id",
        "location_name",
        _not_listed(name, cfg.never_send).alias("can_send_rotations"),
        _not_listed(name, cfg.never_receive).alias("can_receive_rotations"),
        _by_name(name, cfg.receiver_priority, 0).alias("rotation_priority"),
        modelled_at(cfg),
    )


def store_rotation_products(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Flags read from the tags and the title of a product."""
    tags, title = F.col("tags"), F.col("product_title")
    return t["dim_products"].select(
        "product_id",
        matches(tags, cfg.season_pattern).alias("is_season_aw26"),
        matches(tags, cfg.rotation_excluded_pattern).alias("is_aw26_rotation_excluded"),
        matches(title, cfg.sock_pattern).alias("is_sock"),
        matches(tags, cfg.classics_pattern).alias("is_classics"),
        modelled_at(cfg),
    )


def _season_products(t: Tables) -> DataFrame:
    return (
        t["store_rotation_products"]
        .where(F.col("is_season_aw26") & ~F.col("is_aw26_rotation_excluded") & ~F.col("is_sock"))
        .select("product_id", "is_classics")
    )


def _denim_or_classics(product_type: str, is_classics: str) -> Column:
    return F.upper(F.coalesce(F.col(product_type), F.lit(""))).contains(DENIM) | F.col(is_classics)


def store_rotation_candidates(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Every permitted move of a variant between two locations, scored and ranked.

    A variant has at most one row per stock level, so its pairs are bounded by the
    number of locations, and only pairs on permitted lanes are formed at all.
    """
    levels = t["variant_location_demand"].where(F.col("warehouse_available_quantity") <= 0).select(
        "variant_id",
        "product_id",
        "product_title",
        "variant_title",
        "sku",
        "product_type",
        "inventory_item_id",
        "location_id",
        "location_name",
        "available_quantity",
        "style_units_sold_12_weeks",
        "style_demand_score",
        "warehouse_available_quantity",
    )
    locations = t["store_rotation_locations"].select(
        "location_id", "rotation_priority", "can_receive_rotations", "can_send_rotations"
    )
    base = (
        levels.join(locations, "location_id")
        .join(_season_products(t), "product_id")
        .withColumn("denim_or_classics", _denim_or_classics("product_type", "is_classics"))
    )
    pairs = pair_within(
        base,
        "variant_id",
        F.col("can_send_rotations") & (F.col("available_quantity") > 0),
        F.col("can_receive_rotations") & (F.col("available_quantity") < 2),
        cfg.rotation_lanes,
        [
            F.col("s.available_quantity") >= lane_condition("least_units"),
            ~lane_condition("only_empty") | (F.col("r.available_quantity") == 0),
            ~lane_condition("only_higher_demand")
            | (F.col("r.style_demand_score") > F.col("s.style_demand_score")),
            ~lane_condition("only_denim_classics") | F.col("r.denim_or_classics"),
        ],
    )
    receiver, sender = F.col("r.location_name"), F.col("s.location_name")
    sender_units, receiver_units = F.col("s.available_quantity"), F.col("r.available_quantity")
    quantity = (
        F.when(receiver.isin(*cfg.single_unit_receivers), F.lit(1).cast("bigint"))
        .when(receiver_units <= 0, F.least(sender_units, F.lit(2)))
        .when(receiver_units == 1, F.lit(1))
        .otherwise(F.lit(0))
    )
    score = (
        F.col("r.style_demand_score") * SCORE_PER_RECEIVER_DEMAND
        - F.col("s.style_demand_score") * SCORE_PER_SENDER_DEMAND
        + F.col("r.rotation_priority")
        + SCORE_WAREHOUSE_EMPTY
    )
    candidates = pairs.select(
        "variant_id",
        "r.product_id",
        "r.product_title",
        "r.variant_title",
        "r.sku",
        F.col("s.location_id").alias("send_from_location_id"),
        sender.alias("send_from_location_name"),
        sender_units.alias("send_from_available_quantity"),
        F.col("s.style_units_sold_12_weeks").alias("send_from_style_units_12_weeks"),
        F.col("s.style_demand_score").alias("send_from_style_demand_score"),
        F.col("r.location_id").alias("send_to_location_id"),
        receiver.alias("send_to_location_name"),
        receiver_units.alias("send_to_available_quantity"),
        F.col("r.style_units_sold_12_weeks").alias("send_to_style_units_12_weeks"),
        F.col("r.style_demand_score").alias("send_to_style_demand_score"),
        F.col("r.rotation_priority").alias("send_to_rotation_priority"),
        "r.warehouse_available_quantity",
        quantity.alias("recommended_transfer_quantity"),
        _by_name(sender, cfg.donor_tiers, LAST_DONOR_TIER).alias("donor_tier"),
        (F.col("r.style_demand_score") - F.col("s.style_demand_score")).alias("style_demand_gap"),
        score.alias("rotation_score"),
        F.lit(ROTATION_TYPE).alias("recommendation_type"),
        modelled_at(cfg),
        # a variant can have several stock items: they make the rank orders total
        F.col("s.inventory_item_id").alias("send_from_item_id"),
        F.col("r.inventory_item_id").alias("send_to_item_id"),
    )
    items = [F.col("send_from_item_id").asc(), F.col("send_to_item_id").asc()]
    best_donor = Window.partitionBy("variant_id", "send_to_location_id").orderBy(
        F.col("donor_tier").asc(),
        F.col("rotation_score").desc(),
        F.col("send_from_style_demand_score").asc(),
        F.col("send_from_location_name").asc(),
        F.col("send_from_location_id").asc(),
        *items,
    )
    best_receiver = Window.partitionBy("variant_id", "send_from_location_id").orderBy(
        F.col("send_to_available_quantity").asc(),
        F.col("rotation_score").desc(),
        F.col("send_to_style_units_12_weeks").desc(),
        F.col("send_to_rotation_priority").desc(),
        F.col("send_to_location_name").asc(),
        F.col("send_to_location_id").asc(),
        *items,
    )
    return candidates.withColumns(
        {
            "candidate_rank": F.row_number().over(best_donor).cast("bigint"),
            "donor_rank": F.row_number().over(best_receiver).cast("bigint"),
        }
    )


_CANDIDATE_KEY = [
    "variant_id",
    "send_from_location_id",
    "send_to_location_id",
    "send_from_item_id",
    "send_to_item_id",
]


def _highest_score_first() -> list[Column]:
    return [F.col("rotation_score").desc(), *[F.col(name).asc() for name in _CANDIDATE_KEY]]


_REPORT_COLUMNS = [
    "recommendation_type",
    "product_title",
    "variant_title",
    "sku",
    "send_from_location_name",
    "send_to_location_name",
    "recommended_transfer_quantity",
    "send_from_available_quantity",
    "send_to_available_quantity",
    "warehouse_available_quantity",
    "send_from_style_units_12_weeks",
    "send_to_style_units_12_weeks",
]


# names in the texts of reasons -> columns
_REASON_COLUMNS = {
    "units": "recommended_transfer_quantity",
    "sender": "send_from_location_name",
    "receiver": "send_to_location_name",
    "sender_units": "send_from_available_quantity",
    "receiver_units": "send_to_available_quantity",
    "sender_sales": "send_from_style_units_12_weeks",
    "receiver_sales": "send_to_style_units_12_weeks",
    "warehouse_units": "warehouse_available_quantity",
}


def _ranked_report(chosen: DataFrame, reason: str) -> DataFrame:
    needed = [*_REPORT_COLUMNS, "rotation_score", "modelled_at"]
    narrow = chosen.select(*dict.fromkeys([*needed, *_CANDIDATE_KEY]))
    return global_rank(narrow, _highest_score_first(), "rotation_rank").select(
        "rotation_rank",
        *_REPORT_COLUMNS,
        F.round("rotation_score", 1).alias("rotation_score"),
        fill(reason, _REASON_COLUMNS).alias("recommendation_reason"),
        "modelled_at",
    )


def store_rotation_recommendations(t: Tables, cfg: RetailConfig) -> DataFrame:
    """All candidates, ranked by score."""
    chosen = t["store_rotation_candidates"].where(F.col("warehouse_available_quantity") <= 0)
    return _ranked_report(chosen, RECOMMENDATION_REASON)


def _mutual_best(t: Tables) -> DataFrame:
    return t["store_rotation_candidates"].where(
        (F.col("candidate_rank") == 1) & (F.col("donor_rank") == 1)
    )


def store_rotation_report(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Moves that are the best choice for both ends, ranked by score."""
    return _ranked_report(_mutual_best(t), REPORT_REASON)


def store_rotation_workbench(t: Tables, cfg: RetailConfig) -> DataFrame:
    """The report as a sheet: stock and style sales of the listed stores side by side."""
    stores = cfg.workbench_locations
    stock, sales = "stock", "style_sales_12_weeks"
    pivot = pivot_fixed(
        t["variant_location_demand"].where(
            F.col("location_name").isin(*[name for name, _ in stores])
        ),
        "variant_id",
        "location_name",
        stores,
        {stock: "available_quantity", sales: "style_units_sold_12_weeks"},
    )
    moves = _mutual_best(t).select(
        *_CANDIDATE_KEY,
        "send_from_location_name",
        "product_title",
        "variant_title",
        "sku",
        "send_to_location_name",
        "recommended_transfer_quantity",
        "warehouse_available_quantity",
        "rotation_score",
        "recommendation_type",
        "modelled_at",
    )
    sheet_order = [
        F.col(name).asc()
        for name in ("send_from_location_name", "product_title", "variant_title", *_CANDIDATE_KEY)
    ]
    ranked = global_rank(moves.join(pivot, "variant_id", "left"), sheet_order, "sheet_row_number")
    sender, receiver = F.col("send_from_location_name"), F.col("send_to_location_name")
    return ranked.select(
        "sheet_row_number",
        "send_from_location_name",
        "product_title",
        "variant_title",
        "sku",
        "send_to_location_name",
        "recommended_transfer_quantity",
        pick_by_name(sender, stores, stock).alias("send_from_available_quantity"),
        pick_by_name(receiver, stores, stock).alias("send_to_available_quantity"),
        pick_by_name(sender, stores, sales).alias("sender_style_sales_12_weeks"),
        pick_by_name(receiver, stores, sales).alias("receiver_style_sales_12_weeks"),
        *[f"{prefix}_{stock}" for _, prefix in stores],
        "warehouse_available_quantity",
        *[f"{prefix}_{sales}" for _, prefix in stores],
        F.round("rotation_score", 1).alias("rotation_score"),
        "recommendation_type",
        "modelled_at",
    )


def style_consolidation_candidates(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Last unit of a style at a location, moved to the one location with most of it.

    A style with two locations tied for most, or two units to move, gets no move.
    """
    locations = t["store_rotation_locations"].select("location_id", "can_receive_rotations", "can_send_rotations")
    base = (
        t["variant_location_demand"]
        .select(
            "product_id",
            "variant_id",
            "inventory_item_id",
            "product_title",
            "variant_title",
            "sku",
            "product_type",
            "location_id",
            "location_name",
            "available_quantity",
        )
        .join(locations, "location_id", "left")
        .join(_season_products(t), "product_id")
        .withColumn("denim_or_classics", _denim_or_classics("product_type", "is_classics"))
    )
    # all by product: stock of the style at the location and at the warehouse. A product's
    # rows are bounded by its variants and the locations.
    of_product = Window.partitionBy("product_id")
    of_style = Window.partitionBy("product_id", "location_id", "location_name")
    at_warehouse = F.when(F.col("location_name") == cfg.warehouse, F.col("available_quantity"))
    stock = base.withColumns(
        {
            "warehouse_style_available_quantity": F.sum(at_warehouse).over(of_product),
            "style_available_quantity": F.sum("available_quantity").over(of_style),
            "of_location": F.row_number().over(of_style.orderBy("variant_id", "inventory_item_id")),
        }
    )
    pairs = pair_within(
        stock,
        "product_id",
        F.col("can_send_rotations")
        & (F.col("available_quantity") > 0)
        & ~F.col("location_name").isin(*cfg.consolidation_never_send)
        & (F.col("style_available_quantity") == 1)
        & (F.col("warehouse_style_available_quantity") <= 0),
        # a location receives once per style
        F.col("can_receive_rotations") & (F.col("style_available_quantity") > 1) & (F.col("of_location") == 1),
        cfg.consolidation_lanes,
        [~lane_condition("only_denim_classics") | F.col("s.denim_or_classics")],
    )
    candidates = pairs.select(
        "product_id",
        "s.variant_id",
        "s.product_title",
        "s.variant_title",
        "s.sku",
        "s.product_type",
        "s.is_classics",
        F.col("s.location_id").alias("send_from_location_id"),
        F.col("s.location_name").alias("send_from_location_name"),
        F.col("s.available_quantity").alias("send_from_available_quantity"),
        F.col("s.style_available_quantity").alias("send_from_style_available_quantity"),
        F.col("r.location_id").alias("send_to_location_id"),
        F.col("r.location_name").alias("send_to_location_name"),
        F.col("r.style_available_quantity").alias("send_to_style_available_quantity"),
        "s.warehouse_style_available_quantity",
        F.lit(1).cast("bigint").alias("recommended_transfer_quantity"),
        F.lit(CONSOLIDATION_TYPE).alias("recommendation_type"),
        modelled_at(cfg),
        "s.inventory_item_id",
    )
    winners = unique_winner(
        candidates,
        ["product_id", "send_from_location_id"],
        "send_to_style_available_quantity",
        [F.col("send_to_location_id").asc(), F.col("variant_id").asc(), F.col("inventory_item_id").asc()],
    )
    return winners.drop("inventory_item_id").select(
        "*",
        F.col("send_to_style_available_quantity").alias("highest_destination_style_quantity"),
        F.lit(1).cast("bigint").alias("highest_destination_count"),
    )
