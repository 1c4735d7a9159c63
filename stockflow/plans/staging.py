"""Staging tables: typed columns, the latest version of each record, arrays unnested.

Each function takes the mapping of tables and the settings and returns a DataFrame.
The staged order and product rows keep their payload, so lines and variants are
unnested from them: the raw table is ranked and shuffled once per entity, not twice.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.config import RetailConfig
from stockflow.functions import (
    extract_first,
    parse_payload,
    safe_bool,
    safe_long,
    safe_money,
    safe_ts,
    trim_blanks,
)
from stockflow.operators import explode_json_array, latest_by, latest_of_elements, latest_of_wide

Tables = Mapping[str, DataFrame]
ENVELOPE = ["source", "entity", "extracted_at", "payload"]


def _newest() -> list[Column]:
    return [F.col("extracted_at").desc()]


def _raw_tiebreak() -> list[Column]:
    # rows equal in all of these are the same row
    return [F.col("payload").asc(), F.col("source").asc(), F.col("entity").asc()]


def _latest_raw(raw: DataFrame) -> DataFrame:
    return latest_by(raw, ["record_id"], _newest(), _raw_tiebreak())


def _typed(df: DataFrame, **casts) -> DataFrame:
    """Replace text columns by safely cast ones."""
    return df.withColumns({name: cast(F.col(name)) for name, cast in casts.items()})


def products(t: Tables, cfg: RetailConfig) -> DataFrame:
    parsed = parse_payload(
        _latest_raw(t["raw_products"]), "payload", schemas.PRODUCT, ["record_id", *ENVELOPE]
    )
    typed = _typed(
        parsed,
        product_created_at=safe_ts,
        product_updated_at=safe_ts,
        product_published_at=safe_ts,
    )
    return typed.select(
        safe_long(F.col("record_id")).alias("product_id"),
        F.col("record_id").alias("product_key"),
        *schemas.PRODUCT,
        *ENVELOPE,
    )


def product_variants(t: Tables, cfg: RetailConfig) -> DataFrame:
    unnested = explode_json_array(
        t["products"].select(
            "product_id",
            "product_key",
            "product_title",
            F.col("vendor").alias("product_vendor"),
            "product_type",
            F.col("status").alias("product_status"),
            *ENVELOPE,
        ),
        "payload",
        "variants",
        "variant",
    ).drop("payload").withColumnRenamed("variant", "payload")
    keep = [
        "product_id",
        "product_key",
        "product_title",
        "product_vendor AS vendor",
        "product_type",
        "product_status",
        *ENVELOPE,
    ]
    typed = _typed(
        parse_payload(unnested, "payload", schemas.VARIANT, keep),
        price=safe_money,
        compare_at_price=safe_money,
        inventory_quantity=safe_long,
        inventory_item_id=safe_long,
        variant_created_at=safe_ts,
        variant_updated_at=safe_ts,
    ).withColumn("variant_id", safe_long(F.col("variant_key")))
    latest = latest_by(
        typed,
        ["variant_id"],
        _newest(),
        [F.col("product_key").asc(), F.col("payload").asc()],
    )
    return latest.select(
        "product_id",
        "product_key",
        "variant_id",
        *schemas.VARIANT,
        "product_title",
        "vendor",
        "product_type",
        "product_status",
        *ENVELOPE,
    )


def locations(t: Tables, cfg: RetailConfig) -> DataFrame:
    parsed = parse_payload(
        _latest_raw(t["raw_locations"]), "payload", schemas.LOCATION, ["record_id", *ENVELOPE]
    )
    typed = _typed(
        parsed,
        is_active=safe_bool,
        is_legacy=safe_bool,
        location_created_at=safe_ts,
        location_updated_at=safe_ts,
    )
    return typed.select(
        safe_long(F.col("record_id")).alias("location_id"), *schemas.LOCATION, *ENVELOPE
    )


def inventory_levels(t: Tables, cfg: RetailConfig) -> DataFrame:
    parsed = parse_payload(
        t["raw_inventory_levels"], "payload", schemas.INVENTORY_LEVEL, ["record_id", *ENVELOPE]
    )
    latest = latest_by(
        parsed,
        ["inventory_item_id", "location_id"],
        _newest(),
        [F.col("record_id").asc(), *_raw_tiebreak()],
    )
    # the key is made of the texts, so before the casts
    keyed = latest.withColumn(
        "inventory_level_key", F.concat("inventory_item_id", F.lit("-"), "location_id")
    )
    return _typed(
        keyed,
        inventory_item_id=safe_long,
        location_id=safe_long,
        available_quantity=safe_long,
        inventory_level_updated_at=safe_ts,
    ).select(
        "inventory_item_id",
        "location_id",
        "inventory_level_key",
        "available_quantity",
        "inventory_level_updated_at",
        *ENVELOPE,
    )


ORDER_ARRAYS = ("line_items", "shipping_lines", "refunds")


def orders(t: Tables, cfg: RetailConfig) -> DataFrame:
    # the payload is by far the widest column: it crosses no shuffle, and its arrays are kept beside
    # it, so that order lines and daily sales each read their own and parse the whole no more
    latest = latest_of_wide(t["raw_orders"], ["record_id"], F.col("extracted_at"), _raw_tiebreak())
    parsed = parse_payload(latest, "payload", schemas.ORDER, ["record_id", *ENVELOPE], lists=ORDER_ARRAYS)
    typed = _typed(
        parsed,
        total_price=safe_money,
        subtotal_price=safe_money,
        total_tax=safe_money,
        total_discounts=safe_money,
        order_created_at=safe_ts,
        order_updated_at=safe_ts,
        order_cancelled_at=safe_ts,
    )
    return typed.select(
        safe_long(F.col("record_id")).alias("order_id"),
        "order_name",
        "customer_email",
        "financial_status",
        "fulfillment_status",
        "total_price",
        "subtotal_price",
        "total_tax",
        "total_discounts",
        "currency",
        extract_first(F.col("tags"), cfg.order_location_pattern).alias("sales_location_name"),
        "order_created_at",
        "order_updated_at",
        "order_cancelled_at",
        *ENVELOPE,
        *ORDER_ARRAYS,
    )


# what the latest version of a line is chosen by, all read from its payload
_LINE_ORDER = ("order_line_id", "line_product_id", "variant_id", "quantity", "unit_price", "total_discount")


def _typed_line(df: DataFrame, names: Collection[str], keep: list[str]) -> DataFrame:
    """Columns of the order line in the payload, after the columns to keep."""
    parsed = parse_payload(df, "payload", {name: schemas.ORDER_LINE[name] for name in names}, keep)
    casts = {
        "order_line_id": safe_long,
        "variant_id": safe_long,
        "quantity": safe_long,
        "unit_price": safe_money,
        "total_discount": safe_money,
    }
    return _typed(parsed, **{name: cast for name, cast in casts.items() if name in names})


def order_lines(t: Tables, cfg: RetailConfig) -> DataFrame:
    order_columns = ["order_id", "order_name", "order_created_at", "order_updated_at"]
    of_order = [name for name in ENVELOPE if name != "payload"]
    # lines cross the shuffle with their id and what orders them alone, not with their texts
    newest = [F.col("order_updated_at").desc(), *_newest(), F.col("order_id").asc()]

    def identify(lines: DataFrame) -> DataFrame:
        return _typed_line(lines, ("order_line_id",), lines.columns)

    def describe(lines: DataFrame) -> DataFrame:
        return _typed_line(lines, _LINE_ORDER, [*order_columns, *ENVELOPE]).withColumn(
            "line_product_id", safe_long(F.col("line_product_id"))
        )

    latest = latest_of_elements(
        t["orders"].select(*order_columns, *of_order, "line_items"),
        "line_items",
        "payload",
        identify,
        describe,
        ["order_line_id"],
        newest,
        [F.col(name).asc() for name in (*_LINE_ORDER[1:], "payload")],
    )
    product, sku = F.col("line_product_id"), F.col("sku")
    described = _typed_line(latest, schemas.ORDER_LINE, [*order_columns, *ENVELOPE]).withColumns(
        {
            "product_id": safe_long(product),
            "product_reference_status": F.when(product.isNotNull(), "product")
            .when(sku != "", "sku_only")
            .otherwise("non_product_item"),
            "product_key": F.coalesce(product, sku),
        }
    )
    return described.select(
        "order_id",
        "order_name",
        "order_line_id",
        "product_id",
        "variant_id",
        "sku",
        "product_name",
        "variant_title",
        "vendor",
        "product_reference_status",
        "product_key",
        "quantity",
        "unit_price",
        "total_discount",
        "order_created_at",
        "order_updated_at",
        *ENVELOPE,
    )


def customers(t: Tables, cfg: RetailConfig) -> DataFrame:
    """All versions: the latest one per customer is chosen by the customer dimension."""
    parsed = parse_payload(
        t["raw_customers"], "payload", schemas.CUSTOMER, ["record_id", *ENVELOPE]
    )
    typed = _typed(
        parsed,
        email=F.lower,
        orders_count=safe_long,
        total_spent=safe_money,
        verified_email=safe_bool,
        tax_exempt=safe_bool,
        email_marketing_consent_updated_at=safe_ts,
        sms_marketing_consent_updated_at=safe_ts,
        customer_created_at=safe_ts,
        customer_updated_at=safe_ts,
        last_order_id=safe_long,
    )
    first, last = (F.coalesce(name, F.lit("")) for name in ("first_name", "last_name"))
    names = list(schemas.CUSTOMER)
    after_names = names.index("last_name") + 1
    return typed.select(
        safe_long(F.col("record_id")).alias("customer_id"),
        *names[:after_names],
        trim_blanks(F.concat(first, F.lit(" "), last)).alias("full_name"),
        *names[after_names:],
        *ENVELOPE,
    )


STAGING = {
    "products": (products, ("raw_products",)),
    "product_variants": (product_variants, ("products",)),
    "locations": (locations, ("raw_locations",)),
    "inventory_levels": (inventory_levels, ("raw_inventory_levels",)),
    "orders": (orders, ("raw_orders",)),
    "order_lines": (order_lines, ("orders",)),
    "customers": (customers, ("raw_customers",)),
}
