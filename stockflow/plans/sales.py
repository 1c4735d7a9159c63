"""Sales models: order line facts, product and customer dimensions, daily sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow import schemas
from stockflow.config import RetailConfig
from stockflow.functions import local_date, safe_long, safe_money, safe_ts
from stockflow.functions.casts import (
    MONEY,
    money_times_units,
    total,
)
from stockflow.functions.dates import instant
from stockflow.functions.json import parse_payload
from stockflow.operators import latest_by
from stockflow.plans.staging import Tables


def modelled_at(cfg: RetailConfig) -> Column:
    return instant(cfg.as_of).alias("modelled_at")


def fact_sales(t: Tables, cfg: RetailConfig) -> DataFrame:
    """One row per order line. Cancelled orders stay in."""
    lines, orders = t["order_lines"].alias("ol"), t["orders"].alias("o")
    net_sales = money_times_units(F.col("ol.unit_price"), F.col("ol.quantity")) - F.col("ol.total_discount")
    return lines.join(orders, F.col("ol.order_id") == F.col("o.order_id")).select(
        "ol.order_id",
        "ol.order_line_id",
        "o.order_name",
        "ol.order_created_at",
        "o.customer_email",
        "o.sales_location_name",
        "ol.product_id",
        "ol.variant_id",
        "ol.product_key",
        "ol.product_name",
        "ol.variant_title",
        "ol.sku",
        "ol.vendor",
        "ol.quantity",
        "ol.unit_price",
        "ol.total_discount",
        net_sales.alias("net_sales"),
        "o.financial_status",
        "o.fulfillment_status",
        "o.currency",
        modelled_at(cfg),
    )


def dim_locations(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Locations with the name sales use for them and their kind."""
    name = F.col("location_name")
    mapping = t["locations"].sparkSession.createDataFrame(
        list(cfg.sales_location_names), "sales_location_name string, mapped_name string"
    )
    kind = (
        F.when(name == cfg.warehouse, "warehouse")
        .when(name.isin(*cfg.internal_locations), "internal")
        .when(F.col("is_active"), "store")
        .otherwise("inactive")
    )
    return (
        t["locations"]
        # the mapping has one row per entry of the settings
        .join(F.broadcast(mapping), name == F.col("mapped_name"), "left")
        .select(
            "location_id",
            "location_name",
            "sales_location_name",
            "city",
            "province",
            "country",
            "is_active",
            kind.alias("location_type"),
            modelled_at(cfg),
        )
    )


def dim_products(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Products with lifetime sales. Sales are grouped first, so the join is 1:1."""
    sales = (
        t["fact_sales"]
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("units_sold"),
            total(F.col("net_sales")).alias("lifetime_sales"),
            F.min("order_created_at").alias("first_sale_at"),
            F.max("order_created_at").alias("last_sale_at"),
            F.count_distinct("customer_email").alias("unique_customers"),
        )
    )
    attributes = [name for name in t["products"].columns if name not in ("source", "entity", "extracted_at", "payload")]
    return (
        t["products"]
        .select(*attributes)
        .join(sales, "product_id", "left")
        .select(
            *attributes,
            F.coalesce("orders", F.lit(0)).alias("orders"),
            F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
            F.coalesce("lifetime_sales", F.lit(0).cast(MONEY)).alias("lifetime_sales"),
            "first_sale_at",
            "last_sale_at",
            F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
            modelled_at(cfg),
        )
    )


CUSTOMER_ATTRIBUTES = [
    "customer_id",
    "email",
    "first_name",
    "last_name",
    "full_name",
    "phone",
    "customer_state",
    "tags",
    "currency",
    "orders_count",
    "total_spent",
    "verified_email",
    "email_marketing_state",
    "sms_marketing_state",
    "customer_created_at",
    "customer_updated_at",
    "default_country",
    "default_country_code",
    "default_province",
    "default_province_code",
    "default_city",
    "default_postcode",
]


def latest_customers(customers: DataFrame) -> DataFrame:
    return latest_by(
        customers,
        ["customer_id"],
        [F.col("customer_updated_at").desc()],
        [F.col("extracted_at").desc(), F.col("payload").asc()],
    )


def dim_customers(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Customers with lifetime sales under their email, compared without case.

    Sales are grouped per email first. Customers without an email match nothing and
    skip the join: as one NULL key they would all go to a single task.
    """
    sales = (
        t["fact_sales"]
        .where(F.col("customer_email").isNotNull())
        .groupBy(F.lower("customer_email").alias("sales_email"))
        .agg(
            F.count_distinct("order_id").alias("warehouse_orders_count"),
            F.sum("quantity").alias("lifetime_units_sold"),
            total(F.col("net_sales")).alias("lifetime_net_sales"),
            F.min("order_created_at").alias("first_order_at"),
            F.max("order_created_at").alias("last_order_at"),
        )
    )
    latest = latest_customers(t["customers"]).select(*CUSTOMER_ATTRIBUTES)
    # rows without an email get keys of their own, which no email equals
    key = F.coalesce(F.lower("email"), F.concat(F.lit("\u0000"), F.col("customer_id").cast("string")))
    return (
        latest.withColumn("join_email", key)
        .join(sales, F.col("join_email") == F.col("sales_email"), "left")
        .select(
            *[
                F.col(name).alias(
                    {"orders_count": "source_orders_count", "total_spent": "source_total_spent"}.get(name, name)
                )
                for name in CUSTOMER_ATTRIBUTES
            ],
            F.coalesce("warehouse_orders_count", F.lit(0)).alias("warehouse_orders_count"),
            F.coalesce("lifetime_units_sold", F.lit(0)).alias("lifetime_units_sold"),
            F.coalesce("lifetime_net_sales", F.lit(0).cast(MONEY)).alias("lifetime_net_sales"),
            "first_order_at",
            "last_order_at",
            modelled_at(cfg),
        )
    )


# -- daily sales ---------------------------------------------------------------

_MONEY = ["gross_sales", "discounts", "returns", "shipping_sales", "taxes", "total_sales"]
_COUNTS = ["order_count", "returned_units"]


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def _shipping(lines: Column) -> Column:
    """Sum over the shipping lines of one order, without leaving its row."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in schemas.SHIPPING_LINE])

    def amount(line: Column) -> Column:
        fields = F.from_json(line, schema)
        return F.coalesce(
            safe_money(fields["discounted_price"]), safe_money(fields["price"]), F.lit(0)
        )

    nothing = F.lit(0).cast(MONEY)
    added = F.aggregate(lines, nothing, lambda so_far, line: (so_far + amount(line)).cast(MONEY))
    return F.coalesce(added, nothing)


_ORDER_COLUMNS = [
    "order_created_at",
    "sales_location_name",
    "subtotal_price",
    "total_discounts",
    "total_tax_paid",
    "shipping",
]


def _events(t: Tables) -> DataFrame:
    """One row per order (``event_no`` 0) and per refund line of an order, in one pass.

    A refund without lines still gives one row.
    """
    orders = t["orders"].where(F.col("order_cancelled_at").isNull()).select(
        *_ORDER_COLUMNS[:4],
        F.col("total_tax").alias("total_tax_paid"),
        _shipping(F.col("shipping_lines")).alias("shipping"),
        "refunds",
    )
    order_itself = F.array(F.lit(None).cast("string"))
    refunds = F.coalesce("refunds", F.array().cast("array<string>"))
    spread = orders.select(
        *_ORDER_COLUMNS, F.posexplode(F.concat(order_itself, refunds)).alias("event_no", "refund")
    )
    of_refund = parse_payload(
        spread,
        "refund",
        {"processed_at": "processed_at"},
        [*_ORDER_COLUMNS, "event_no"],
        lists=("transactions", "refund_line_items"),
    )
    located = parse_payload(
        of_refund.withColumn("first_transaction", F.get("transactions", F.lit(0))),
        "first_transaction",
        {"transaction_location_id": "location_id"},
        [*_ORDER_COLUMNS, "event_no", "processed_at", "refund_line_items"],
    )
    return parse_payload(
        located.withColumn("refund_line", F.explode_outer("refund_line_items")),
        "refund_line",
        schemas.REFUND_LINE,
        [*_ORDER_COLUMNS, "event_no", "processed_at", "transaction_location_id"],
    )


def _daily_groups(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Orders per date and sales name, refunds per date and location."""
    is_order = F.col("event_no") == 0
    location = F.coalesce(
        safe_long(F.col("line_location_id")), safe_long(F.col("transaction_location_id"))
    )
    happened = F.when(is_order, F.col("order_created_at")).otherwise(safe_ts(F.col("processed_at")))
    events = _events(t).select(
        "*",
        is_order.alias("is_order"),
        local_date(happened, cfg.trading_zone).alias("trading_date"),
        F.when(is_order, F.col("sales_location_name")).alias("order_name_of_place"),
        F.when(~is_order, location).alias("refund_place"),
    )
    subtotal, discounts, taxes = F.col("subtotal_price"), F.col("total_discounts"), F.col("total_tax_paid")

    def of_orders(amount: Column) -> Column:
        return total(F.when(F.col("is_order"), amount))

    def of_refunds(amount: Column) -> Column:
        return total(F.when(~F.col("is_order"), F.coalesce(amount, F.lit(0))))

    return (
        events.groupBy("trading_date", "is_order", "order_name_of_place", "refund_place")
        .agg(
            # a filter on the key itself would be moved below, and parse every event twice
            F.max("trading_date").alias("dated"),
            of_orders(subtotal + discounts).alias("gross_sales"),
            of_orders(discounts).alias("discounts"),
            of_orders(F.col("shipping")).alias("shipping_sales"),
            of_orders(taxes).alias("order_taxes"),
            of_orders(subtotal + taxes + F.col("shipping")).alias("order_total"),
            F.count_if("is_order").alias("order_count"),
            of_refunds(safe_money(F.col("refund_subtotal"))).alias("refunded"),
            of_refunds(safe_money(F.col("refund_tax"))).alias("refunded_tax"),
            F.sum(
                F.when(~F.col("is_order"), F.coalesce(safe_long(F.col("quantity")), F.lit(0)))
            ).alias("returned_units"),
        )
        .where(F.col("dated").isNotNull())
    )


def fact_daily_sales(t: Tables, cfg: RetailConfig) -> DataFrame:
    """Orders and refunds per trading date and location.

    Events are grouped before the location is looked up, so what is joined and
    shuffled a second time is one row per date and location, not one per order.
    """
    places = t["dim_locations"].select("location_id", "location_name", "sales_location_name")
    by_name = places.select(
        F.col("location_id").alias("named_id"),
        F.col("location_name").alias("named_location"),
        F.col("sales_location_name").alias("known_name"),
    )
    by_id = places.withColumnRenamed("location_id", "known_id")
    is_order, zero = F.col("is_order"), _zero()
    refunded, refunded_tax = F.col("refunded"), F.col("refunded_tax")

    def either(of_order: Column, of_refund: Column) -> Column:
        return F.when(is_order, of_order).otherwise(of_refund)

    located = (
        _daily_groups(t, cfg)
        .join(by_name, F.col("order_name_of_place") == F.col("known_name"), "left")
        .join(by_id, F.col("refund_place") == F.col("known_id"), "left")
        .select(
            "trading_date",
            either(F.col("named_id"), F.col("refund_place")).alias("location_id"),
            F.coalesce(
                either(F.col("named_location"), F.col("location_name")),
                F.col("order_name_of_place"),
                F.lit("Unknown"),
            ).alias("location_name"),
            either(F.col("order_name_of_place"), F.col("sales_location_name")).alias("sales_location_name"),
            either(F.col("gross_sales"), zero).alias("gross_sales"),
            either(F.col("discounts"), zero).alias("discounts"),
            either(zero, F.col("refunded")).alias("returns"),
            either(F.col("shipping_sales"), zero).alias("shipping_sales"),
            either(F.col("order_taxes"), -F.col("refunded_tax")).alias("taxes"),
            either(F.col("order_total"), -refunded - refunded_tax).alias("total_sales"),
            "order_count",
            either(F.lit(0), F.col("returned_units")).alias("returned_units"),
        )
    )
    keys = ["trading_date", "location_id", "location_name", "sales_location_name"]
    return (
        located.groupBy(*keys)
        .agg(
            *[total(F.col(name)).alias(name) for name in _MONEY],
            *[F.sum(name).alias(name) for name in _COUNTS],
        )
        .select(*keys, *_MONEY, *_COUNTS, modelled_at(cfg))
    )
