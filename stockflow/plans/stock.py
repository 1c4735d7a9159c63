"""Stock models: inventory snapshot, demand, weeks of cover, negative stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.config import (
    LOW_COVER_WEEKS,
    OVERSTOCK_WEEKS,
    WEEKS_IN_30_DAYS,
    RetailConfig,
)
from stockflow.functions import days_before, days_between, has_tag, safe_divide, utc_date
from stockflow.functions.dates import instant
from stockflow.operators import windowed_units
from stockflow.operators.units import regroup_units
from stockflow.plans.sales import modelled_at
from stockflow.plans.staging import Tables


def fact_inventory_snapshot(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Current stock per variant and location; levels without a match are left out.

    No join hints: locations are broadcast if their measured size allows it, and
    joined by shuffle, with skewed locations split, if it does not.
    """
    variants = t["product_variants"].select(
        "inventory_item_id",
        "product_id",
        "variant_id",
        "product_title",
        "variant_title",
        "sku",
        "vendor",
        "product_type",
    )
    products = t["products"].select("product_id", F.col("status").alias("product_status"))
    locations = t["locations"].select("location_id", "location_name", "city")
    levels = t["inventory_levels"].select(
        "inventory_level_key",
        "inventory_item_id",
        "location_id",
        "available_quantity",
        "inventory_level_updated_at",
    )
    described = variants.join(products, "product_id")
    return (
        levels.join(locations, "location_id")
        .join(described, "inventory_item_id")
        .select(
            "inventory_level_key",
            "location_id",
            "location_name",
            "city",
            "inventory_item_id",
            "product_id",
            "variant_id",
            "product_title",
            "variant_title",
            "sku",
            "vendor",
            "product_type",
            F.coalesce("available_quantity", F.lit(0)).alias("available_quantity"),
            "product_status",
            "inventory_level_updated_at",
            modelled_at(cfg),
        )
    )


def style_location_demand(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Units per product and location over 4 and 12 weeks, and a demand score.

    Sales are grouped by the name they carry before it is translated to a location.
    """
    units = {"style_units_4_weeks": 28, "style_units_12_weeks": 84}
    by_sales_name = windowed_units(
        t["fact_sales"].where(F.col("sales_location_name").isNotNull()),
        ["product_id", "sales_location_name"],
        "order_created_at",
        "quantity",
        cfg.as_of,
        units,
    )
    names = t["dim_locations"].select("sales_location_name", "location_name")
    summary = regroup_units(
        by_sales_name.join(names, "sales_location_name"), ["product_id", "location_name"], list(units)
    )
    weekly = safe_divide(F.col("style_units_4_weeks"), F.lit(4)) + safe_divide(
        F.col("style_units_12_weeks"), F.lit(12)
    )
    return summary.select(
        "product_id",
        "location_name",
        *units,
        weekly.alias("demand_score"),
        F.col("last_at").alias("last_sale_at"),
        modelled_at(cfg),
    )


def _by_place(rows: DataFrame, key: str, place: str, out: str) -> DataFrame:
    """One row per key: a map ``out`` from the place to the other columns of its one row."""
    values = F.struct(*[name for name in rows.columns if name not in (key, place)])
    known = rows.where(F.col(key).isNotNull() & F.col(place).isNotNull())
    return known.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col(place), values))).alias(out))


def variant_location_demand(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Every stock level with the demand for its variant and style at that location."""
    units = {"units_sold_4_weeks": 28, "units_sold_12_weeks": 84}
    sales = windowed_units(
        t["fact_sales"].where(
            F.col("sales_location_name").isNotNull() & F.col("variant_id").isNotNull()
        ),
        ["variant_id", "sales_location_name"],
        "order_created_at",
        "quantity",
        cfg.as_of,
        units,
    )
    snapshot = t["fact_inventory_snapshot"]
    warehouse = (
        snapshot.where(F.col("location_name") == cfg.warehouse)
        .groupBy("variant_id")
        .agg(F.sum("available_quantity").alias("warehouse_units"))
    )
    names = t["dim_locations"].select("location_id", "sales_location_name")
    # only names that a level is looked up by, so a variant has at most one entry per location
    sold = _by_place(sales.join(names, "sales_location_name", "left_semi"), "variant_id", "sales_location_name", "sold")
    style = _by_place(
        t["style_location_demand"].select(
            "product_id", "location_name", "style_units_4_weeks", "style_units_12_weeks", "demand_score"
        ),
        "product_id",
        "location_name",
        "style",
    )
    # whatever is looked up is gathered per variant first: levels, the widest rows, are shuffled once
    demand = (
        snapshot.groupBy("variant_id")
        # in structs, as a set leaves out NULL
        .agg(F.collect_set(F.struct("product_id")).alias("products"))
        .join(warehouse, "variant_id", "left")
        .join(sold, "variant_id", "left")
        .select(F.col("variant_id").alias("of_variant"), "warehouse_units", "sold", F.inline("products"))
        .join(style, "product_id", "left")
        .withColumnRenamed("product_id", "of_product")
    )
    same = F.col("variant_id").eqNullSafe(F.col("of_variant")) & F.col("product_id").eqNullSafe(F.col("of_product"))

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    joined = (
        snapshot.join(names, "location_id", "left")
        .join(demand, same, "left")
        .withColumn("sold", F.try_element_at("sold", F.col("sales_location_name")))
        .withColumn("style", F.try_element_at("style", F.col("location_name")))
        .select(*snapshot.columns, "warehouse_units", "sold.*", "style.*")
    )
    today = utc_date(instant(cfg.as_of))
    return joined.select(
        "location_id",
        "location_name",
        "product_id",
        "variant_id",
        "inventory_item_id",
        "product_title",
        "variant_title",
        "sku",
        "vendor",
        "product_type",
        "product_status",
        "available_quantity",
        or_zero("units_sold_4_weeks").alias("units_sold_4_weeks"),
        or_zero("units_sold_12_weeks").alias("units_sold_12_weeks"),
        or_zero("style_units_4_weeks").alias("style_units_sold_4_weeks"),
        or_zero("style_units_12_weeks").alias("style_units_sold_12_weeks"),
        F.coalesce("demand_score", F.lit(0.0)).alias("style_demand_score"),
        F.col("first_at").alias("first_sale_at"),
        F.col("last_at").alias("last_sale_at"),
        days_between(today, utc_date(F.col("last_at"))).alias("days_since_last_sale"),
        (or_zero("units_sold_12_weeks") > 0).alias("has_recent_demand"),
        (F.col("available_quantity") <= 0).alias("currently_out_of_stock"),
        or_zero("warehouse_units").alias("warehouse_available_quantity"),
        (or_zero("warehouse_units") <= 0).alias("warehouse_out_of_stock"),
        modelled_at(cfg),
    )


def weeks_of_cover(t: Tables, cfg: RetailConfig) -> DataFrame:
    """How long the stock of a level lasts at the last 30 days' rate of all locations."""
    sales = (
        t["fact_sales"]
        .where(
            (F.col("order_created_at") >= days_before(cfg.as_of, 30)) & F.col("variant_id").isNotNull()
        )
        .groupBy("variant_id")
        .agg(F.sum("quantity").alias("recent_units"))
    )
    inventory = t["fact_inventory_snapshot"].select(
        "location_id",
        "location_name",
        "product_id",
        "variant_id",
        "product_title",
        "variant_title",
        "sku",
        "vendor",
        "product_type",
        "product_status",
        "available_quantity",
    )
    units = F.coalesce(F.col("recent_units"), F.lit(0))
    base = (
        inventory.join(sales, "variant_id", "left")
        .withColumn("units_sold_30_days", units)
        .withColumn(
            "raw_weeks_of_cover",
            safe_divide(
                F.col("available_quantity"),
                safe_divide(F.col("units_sold_30_days"), F.lit(WEEKS_IN_30_DAYS)),
            ),
        )
    )
    available, weeks = F.col("available_quantity"), F.col("raw_weeks_of_cover")
    status = (
        F.when(available < 0, "negative_stock")
        .when(available == 0, "out_of_stock")
        .when(F.col("units_sold_30_days") == 0, "no_recent_sales")
        .when(weeks < LOW_COVER_WEEKS, "low_cover")
        .when(weeks > OVERSTOCK_WEEKS, "overstocked")
        .otherwise("healthy")
    )
    return base.select(
        *inventory.columns,
        "units_sold_30_days",
        "raw_weeks_of_cover",
        F.round(weeks, 1).alias("weeks_of_cover"),
        status.alias("stock_status"),
        modelled_at(cfg),
    )


def negative_stock_report(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Season stock below zero at the listed locations."""
    season = t["products"].where(has_tag(F.col("tags"), cfg.season_tag)).select("product_id")
    negative = t["fact_inventory_snapshot"].where(
        (F.col("available_quantity") < 0) & F.col("location_name").isin(*cfg.negative_stock_locations)
    )
    return negative.join(season, "product_id", "inner").select(
        "location_id",
        "location_name",
        "city",
        "product_title",
        "variant_title",
        "sku",
        "product_type",
        "product_status",
        "available_quantity",
        F.abs("available_quantity").alias("negative_units"),
        "inventory_level_updated_at",
        "modelled_at",
    )


def negative_stock_location_summary(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Counts and extremes of the negative stock report per location."""
    return (
        t["negative_stock_report"]
        .groupBy("location_id", "location_name", "city")
        .agg(
            F.count(F.lit(1)).alias("negative_variant_count"),
            F.sum("negative_units").alias("total_negative_units"),
            F.min("available_quantity").alias("lowest_available_quantity"),
            F.max("inventory_level_updated_at").alias("latest_inventory_update"),
            F.max("modelled_at").alias("report_updated_at"),
        )
    )
