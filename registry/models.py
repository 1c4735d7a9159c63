"""One query per staging table and mart model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.flat_sql import (
    AS_OF,
    CANDIDATE_CHAIN,
    CUST_VERSION,
    DEMAND_CHAIN,
    LEVEL,
    LINE,
    LOC,
    ORD,
    LINES,
    PROD,
    ROTATION_CHAIN,
    SALES_CHAIN,
    STOCK_CHAIN,
    STYLE_DEMAND,
    VARIANT,
    melbourne_date,
    money,
    text_of,
    with_ctes,
)
from registry.warehouse import open_warehouse, present


def _model(name: str, *drop: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(open_warehouse(spark, folder).model(name), *drop)

    return run


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    # with the time of extraction, which tells the versions of a customer apart
    staged = open_warehouse(spark, folder).model("customers")
    return present(staged.withColumn("extracted_on", F.to_date("extracted_at")))


_ITEM_KEYS = ("send_from_item_id", "send_to_item_id")

MODEL_QUERIES = {
    "stg_products": _model("products"),
    "stg_product_variants": _model("product_variants"),
    "stg_locations": _model("locations"),
    "stg_inventory_levels": _model("inventory_levels"),
    "stg_orders": _model("orders"),
    "stg_order_lines": _model("order_lines"),
    "stg_customers": _customers,
    "fact_sales": _model("fact_sales"),
    "dim_locations": _model("dim_locations"),
    "dim_products": _model("dim_products"),
    "dim_customers": _model("dim_customers"),
    "fact_inventory": _model("fact_inventory_snapshot"),
    "fact_daily_sales": _model("fact_daily_sales"),
    "style_demand": _model("style_location_demand"),
    "variant_demand": _model("variant_location_demand"),
    "weeks_of_cover": _model("weeks_of_cover"),
    "negative_stock": _model("negative_stock_report"),
    "negative_stock_summary": _model("negative_stock_location_summary"),
    "rotation_locations": _model("store_rotation_locations"),
    "rotation_products": _model("store_rotation_products"),
    "rotation_candidates": _model("store_rotation_candidates", *_ITEM_KEYS),
    "rotation_recommendations": _model("store_rotation_recommendations"),
    "rotation_report": _model("store_rotation_report"),
    "rotation_workbench": _model("store_rotation_workbench"),
    "consolidation": _model("style_consolidation_candidates"),
}

_PUBLISHED = "CASE WHEN status = 'active' THEN '1996-12-31 13:00:00' END"

_STG_PRODUCTS = f"""
SELECT product_id, product_key, product_title, handle, vendor, product_type, status, tags,
       '1995-01-01 00:00:00' AS product_created_at, '1997-03-01 00:00:00' AS product_updated_at,
       {_PUBLISHED} AS product_published_at
FROM prod"""

_STG_VARIANTS = f"""
SELECT product_id, product_key, variant_id, CAST(variant_id AS VARCHAR) AS variant_key, sku, variant_title,
       barcode, {money('price')} AS price, {money('compare_at_price')} AS compare_at_price,
       inventory_quantity, inventory_item_id, 'deny' AS inventory_policy, 'shop' AS inventory_management,
       '1995-01-01 00:00:00' AS variant_created_at, '1996-01-01 00:00:00' AS variant_updated_at,
       product_title, vendor, product_type, product_status
FROM variant"""

_STG_LOCATIONS = """
SELECT location_id, location_name, address1, address2, city, province, province_code, country,
       country_code, postcode, is_active, is_legacy,
       '1995-01-01 00:00:00' AS location_created_at, '1995-06-01 00:00:00' AS location_updated_at
FROM loc"""

_STG_LEVELS = """
SELECT inventory_item_id, location_id, inventory_item_id || '-' || location_id AS inventory_level_key,
       available_quantity, '2001-07-31 00:00:00' AS inventory_level_updated_at
FROM level"""

_STG_ORDERS = f"""
SELECT order_id, order_name, customer_email, 'paid' AS financial_status, fulfillment_status,
       {money('subtotal + taxes')} AS total_price, {money('subtotal')} AS subtotal_price,
       {money('taxes')} AS total_tax, {money('discounts')} AS total_discounts, 'AUD' AS currency,
       sales_location_name, {text_of('created')} AS order_created_at, {text_of('updated')} AS order_updated_at,
       {text_of('cancelled')} AS order_cancelled_at
FROM ord"""

_STG_LINES = f"""
SELECT order_id, order_name, order_line_id, product_id, variant_id, sku, product_name, variant_title, vendor,
       product_reference_status, COALESCE(CAST(product_id AS VARCHAR), sku) AS product_key, quantity,
       {money('unit_price')} AS unit_price, {money('total_discount')} AS total_discount,
       {text_of('order_created_at')} AS order_created_at, {text_of('order_updated_at')} AS order_updated_at
FROM line"""

_STG_CUSTOMERS = """
SELECT customer_id, email, first_name, last_name, full_name, phone, customer_state, tags, currency,
       orders_count, total_spent, verified_email, tax_exempt,
       CASE WHEN by_email THEN consent END AS email_marketing_state,
       CASE WHEN by_email THEN 'single_opt_in' END AS email_marketing_opt_in_level,
       CASE WHEN by_email THEN consent_at END AS email_marketing_consent_updated_at,
       CASE WHEN NOT by_email THEN consent END AS sms_marketing_state,
       CASE WHEN NOT by_email THEN 'single_opt_in' END AS sms_marketing_opt_in_level,
       CASE WHEN NOT by_email THEN consent_at END AS sms_marketing_consent_updated_at,
       '1995-01-01 00:00:00' AS customer_created_at, customer_updated_at, last_order_id, last_order_name,
       CASE WHEN has_address THEN country END AS default_country,
       CASE WHEN has_address THEN country_code END AS default_country_code,
       CASE WHEN has_address THEN province END AS default_province,
       CASE WHEN has_address THEN province_code END AS default_province_code,
       CASE WHEN has_address THEN city END AS default_city,
       CASE WHEN has_address THEN postcode END AS default_postcode,
       CASE WHEN has_address THEN address_phone END AS default_phone,
       CASE version WHEN 1 THEN '2001-08-01' ELSE '2001-07-31' END AS extracted_on
FROM cust_version"""

_FACT_SALES = f"""
SELECT order_id, order_line_id, order_name, {text_of('order_created_at')} AS order_created_at, customer_email,
       sales_location_name, product_id, variant_id, COALESCE(CAST(product_id AS VARCHAR), sku) AS product_key,
       product_name, variant_title, sku, vendor, quantity, {money('unit_price')} AS unit_price,
       {money('total_discount')} AS total_discount, {money('net_sales')} AS net_sales,
       'paid' AS financial_status, fulfillment_status, 'AUD' AS currency
FROM sale"""

_DIM_LOCATIONS = """
SELECT location_id, location_name, sales_location_name, city, province, country, is_active,
       CASE WHEN location_name = 'Online / Warehouse' THEN 'warehouse'
            WHEN location_name IN ('Faulty Land', 'Sparehouse') THEN 'internal'
            WHEN is_active THEN 'store' ELSE 'inactive' END AS location_type
FROM loc"""

_DIM_PRODUCTS = f"""
SELECT p.product_id, p.product_key, product_title, handle, p.vendor, product_type, status, tags,
       '1995-01-01 00:00:00' AS product_created_at, '1997-03-01 00:00:00' AS product_updated_at,
       {_PUBLISHED} AS product_published_at,
       count(DISTINCT order_id) AS orders, CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS units_sold,
       {money('COALESCE(sum(net_sales), 0)')} AS lifetime_sales,
       {text_of('min(order_created_at)')} AS first_sale_at, {text_of('max(order_created_at)')} AS last_sale_at,
       count(DISTINCT customer_email) AS unique_customers
FROM prod AS p LEFT JOIN sale AS s ON p.product_id = s.product_id
GROUP BY ALL"""

_DIM_CUSTOMERS = f"""
SELECT customer_id, email, first_name, last_name, full_name, phone, customer_state, tags, currency,
       orders_count AS source_orders_count, total_spent AS source_total_spent, verified_email,
       CASE WHEN by_email THEN consent END AS email_marketing_state,
       CASE WHEN NOT by_email THEN consent END AS sms_marketing_state,
       '1995-01-01 00:00:00' AS customer_created_at, customer_updated_at,
       CASE WHEN has_address THEN country END AS default_country,
       CASE WHEN has_address THEN country_code END AS default_country_code,
       CASE WHEN has_address THEN province END AS default_province,
       CASE WHEN has_address THEN province_code END AS default_province_code,
       CASE WHEN has_address THEN city END AS default_city,
       CASE WHEN has_address THEN postcode END AS default_postcode,
       count(DISTINCT order_id) AS warehouse_orders_count,
       CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS lifetime_units_sold,
       {money('COALESCE(sum(net_sales), 0)')} AS lifetime_net_sales,
       {text_of('min(order_created_at)')} AS first_order_at, {text_of('max(order_created_at)')} AS last_order_at
FROM cust_version AS c LEFT JOIN sale AS s ON lower(c.email) = lower(s.customer_email)
WHERE version = 1
GROUP BY ALL"""

_FACT_INVENTORY = """
SELECT inventory_level_key, location_id, location_name, city, inventory_item_id, product_id, variant_id,
       product_title, variant_title, sku, vendor, product_type, available_quantity, product_status,
       '2001-07-31 00:00:00' AS inventory_level_updated_at
FROM snapshot"""

_DAILY_EVENTS = f"""
event AS (
  SELECT {melbourne_date('created')} AS trading_date, location_id,
         COALESCE(location_name, ord.sales_location_name, 'Unknown') AS location_name, ord.sales_location_name,
         subtotal + discounts AS gross_sales, discounts, 0.00 AS returns, shipping AS shipping_sales,
         taxes, subtotal + shipping + taxes AS total_sales, 1 AS order_count, 0 AS returned_units
  FROM ord LEFT JOIN loc ON ord.sales_location_name = loc.sales_location_name
  WHERE cancelled IS NULL
  UNION ALL
  SELECT trading_date, r.location_id, COALESCE(location_name, 'Unknown'), sales_location_name,
         0, 0, returns, 0, -returned_tax, -returns - returned_tax, 0, returned_units
  FROM (
    SELECT {melbourne_date('(CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber * 3))')} AS trading_date,
           CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey % 16 ELSE (l_suppkey + 3) % 16 END AS location_id,
           gross - discount AS returns, tax AS returned_tax, units AS returned_units
    FROM item JOIN ord ON item.order_id = ord.order_id
    WHERE l_returnflag = 'R' AND cancelled IS NULL
    UNION ALL
    SELECT {melbourne_date('created')}, CASE WHEN o_orderkey % 50 = 0 THEN o_custkey % 14 END, 0, 0, 0
    FROM ord WHERE cancelled IS NULL AND o_orderkey % 50 IN (0, 25) AND order_id = o_orderkey
  ) AS r LEFT JOIN loc ON r.location_id = loc.location_id
)"""

_FACT_DAILY = f"""
SELECT trading_date, location_id, location_name, sales_location_name,
       {money('sum(gross_sales)')} AS gross_sales, {money('sum(discounts)')} AS discounts,
       {money('sum(returns)')} AS returns, {money('sum(shipping_sales)')} AS shipping_sales,
       {money('sum(taxes)')} AS taxes, {money('sum(total_sales)')} AS total_sales,
       CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(returned_units) AS BIGINT) AS returned_units
FROM event GROUP BY trading_date, location_id, location_name, sales_location_name"""

_STYLE_DEMAND = f"""
SELECT product_id, location_name, style_units_4_weeks, style_units_12_weeks, demand_score,
       {text_of('last_sale_at')} AS last_sale_at
FROM style_score"""

_VARIANT_DEMAND = f"""
SELECT location_id, location_name, product_id, variant_id, inventory_item_id, product_title, variant_title,
       sku, vendor, product_type, product_status, available_quantity, units_sold_4_weeks, units_sold_12_weeks,
       style_units_sold_4_weeks, style_units_sold_12_weeks, style_demand_score,
       {text_of('first_at')} AS first_sale_at, {text_of('last_at')} AS last_sale_at,
       date_diff('day', CAST(last_at AS DATE), CAST({AS_OF} AS DATE)) AS days_since_last_sale,
       units_sold_12_weeks > 0 AS has_recent_demand, available_quantity <= 0 AS currently_out_of_stock,
       warehouse_available_quantity, warehouse_available_quantity <= 0 AS warehouse_out_of_stock
FROM demand"""

_WEEKS = f"""
SELECT location_id, location_name, product_id, variant_id, product_title, variant_title, sku, vendor,
       product_type, product_status, available_quantity, units_sold_30_days, raw_weeks_of_cover,
       round(raw_weeks_of_cover, 1) AS weeks_of_cover,
       CASE WHEN available_quantity < 0 THEN 'negative_stock' WHEN available_quantity = 0 THEN 'out_of_stock'
            WHEN units_sold_30_days = 0 THEN 'no_recent_sales' WHEN raw_weeks_of_cover < 2 THEN 'low_cover'
            WHEN raw_weeks_of_cover > 12 THEN 'overstocked' ELSE 'healthy' END AS stock_status
FROM (
  SELECT s.*, COALESCE(units, 0) AS units_sold_30_days,
         CASE WHEN units <> 0
              THEN CAST(available_quantity AS DOUBLE) / (CAST(units AS DOUBLE) / CAST(4.2857 AS DOUBLE))
         END AS raw_weeks_of_cover
  FROM snapshot AS s LEFT JOIN (
    SELECT variant_id, CAST(sum(quantity) AS BIGINT) AS units FROM sale
    WHERE order_created_at >= {AS_OF} - INTERVAL 30 DAY GROUP BY variant_id
  ) AS recent ON s.variant_id = recent.variant_id
)"""

_NEGATIVE = """
SELECT s.location_id, s.location_name, s.city, s.product_title, s.variant_title, s.sku, s.product_type,
       s.product_status, s.available_quantity, abs(s.available_quantity) AS negative_units,
       '2001-07-31 00:00:00' AS inventory_level_updated_at
FROM snapshot AS s
WHERE s.available_quantity < 0
  AND s.location_name IN ('Claremont', 'Fitzroy', 'Flinders Lane', 'James St', 'Newtown', 'Oxford St',
                          'Online / Warehouse', 'Smith St')
  AND s.product_id IN (
    SELECT product_id FROM prod
    WHERE list_contains(list_transform(string_split(tags, ','), lambda x: upper(trim(x))), 'SEASON_AW26'))"""

_NEGATIVE_SUMMARY = f"""
SELECT location_id, location_name, city, count(*) AS negative_variant_count,
       CAST(sum(negative_units) AS BIGINT) AS total_negative_units,
       min(available_quantity) AS lowest_available_quantity,
       max(inventory_level_updated_at) AS latest_inventory_update
FROM ({_NEGATIVE}) GROUP BY location_id, location_name, city"""

_ROTATION_LOCATIONS = """
SELECT location_id, location_name, can_send AS can_send_rotations, can_receive AS can_receive_rotations,
       priority AS rotation_priority
FROM place"""

_ROTATION_PRODUCTS = r"""
SELECT product_id,
       regexp_matches(lower(tags), '(^|,\s*)season_aw26(\s*,|$)') AS is_season_aw26,
       regexp_matches(lower(tags), '(^|,\s*)aw26 rotation') AS is_aw26_rotation_excluded,
       regexp_matches(lower(product_title), '\brings?\b') AS is_sock,
       regexp_matches(lower(tags), '(^|,\s*)classics(\s*,|$)') AS is_classics
FROM prod"""

_CANDIDATES = """
SELECT variant_id, product_id, product_title, variant_title, sku, send_from_location_id,
       send_from_location_name, send_from_available_quantity, send_from_style_units_12_weeks,
       send_from_style_demand_score, send_to_location_id, send_to_location_name, send_to_available_quantity,
       send_to_style_units_12_weeks, send_to_style_demand_score, send_to_rotation_priority,
       warehouse_available_quantity, CAST(recommended_transfer_quantity AS BIGINT) AS recommended_transfer_quantity,
       donor_tier, style_demand_gap, rotation_score,
       'rotation_recommendation_warehouse_empty' AS recommendation_type, candidate_rank, donor_rank
FROM candidate"""

_REPORT_COLUMNS = """
       'rotation_recommendation_warehouse_empty' AS recommendation_type, product_title, variant_title, sku,
       send_from_location_name, send_to_location_name,
       CAST(recommended_transfer_quantity AS BIGINT) AS recommended_transfer_quantity,
       send_from_available_quantity, send_to_available_quantity, warehouse_available_quantity,
       send_from_style_units_12_weeks, send_to_style_units_12_weeks,
       round(rotation_score, 1) AS rotation_score"""
_BY_SCORE = """row_number() OVER (
         ORDER BY rotation_score DESC, variant_id, send_from_location_id, send_to_location_id) AS rotation_rank"""

_RECOMMENDATIONS = f"""
SELECT {_BY_SCORE}, {_REPORT_COLUMNS},
       'Move ' || recommended_transfer_quantity || ' unit from ' || send_from_location_name || ' to '
         || send_to_location_name || '. Warehouse has ' || warehouse_available_quantity || ' units remaining.'
         AS recommendation_reason
FROM candidate WHERE warehouse_available_quantity <= 0"""

_REPORT = f"""
SELECT {_BY_SCORE}, {_REPORT_COLUMNS},
       format('Move {{}} unit from {{}} to {{}}. {{}} has {{}} units and sold {{}} style units in 12 weeks. '
              || '{{}} has {{}} units and sold {{}} style units. Warehouse has {{}} units.',
              recommended_transfer_quantity, send_from_location_name, send_to_location_name,
              send_to_location_name, send_to_available_quantity, send_to_style_units_12_weeks,
              send_from_location_name, send_from_available_quantity, send_from_style_units_12_weeks,
              warehouse_available_quantity) AS recommendation_reason
FROM candidate WHERE candidate_rank = 1 AND donor_rank = 1"""

_STORES = {
    "Oxford St": "oxford_st",
    "Newtown": "newtown",
    "Fitzroy": "fitzroy",
    "Flinders Lane": "flinders_lane",
    "James St": "james_st",
    "Claremont": "claremont",
    "Wellington": "wellington",
    "Paddington": "paddington",
}


def _cells(column: str, suffix: str) -> str:
    return ", ".join(
        f"max({column}) FILTER (location_name = '{name}') AS {prefix}_{suffix}"
        for name, prefix in _STORES.items()
    )


def _cell_of(name: str, suffix: str) -> str:
    cases = " ".join(f"WHEN '{store}' THEN {prefix}_{suffix}" for store, prefix in _STORES.items())
    return f"CASE {name} {cases} END"


_CELL_COLUMNS = ", ".join(
    f"{prefix}_{suffix}" for suffix in ("stock", "style_sales_12_weeks") for prefix in _STORES.values()
)
_WORKBENCH = f"""
SELECT row_number() OVER (ORDER BY send_from_location_name, product_title, variant_title, c.variant_id,
                          send_from_location_id, send_to_location_id) AS sheet_row_number,
       send_from_location_name, product_title, variant_title, sku, send_to_location_name,
       CAST(recommended_transfer_quantity AS BIGINT) AS recommended_transfer_quantity,
       {_cell_of('send_from_location_name', 'stock')} AS send_from_available_quantity,
       {_cell_of('send_to_location_name', 'stock')} AS send_to_available_quantity,
       {_cell_of('send_from_location_name', 'style_sales_12_weeks')} AS sender_style_sales_12_weeks,
       {_cell_of('send_to_location_name', 'style_sales_12_weeks')} AS receiver_style_sales_12_weeks,
       {_CELL_COLUMNS}, warehouse_available_quantity, round(rotation_score, 1) AS rotation_score,
       'rotation_recommendation_warehouse_empty' AS recommendation_type
FROM candidate AS c LEFT JOIN (
  SELECT variant_id, {_cells('available_quantity', 'stock')},
         {_cells('style_units_sold_12_weeks', 'style_sales_12_weeks')}
  FROM demand GROUP BY variant_id
) AS cells ON c.variant_id = cells.variant_id
WHERE candidate_rank = 1 AND donor_rank = 1"""

_CONSOLIDATION_CTES = """
style_stock AS (
  SELECT product_id, location_id, location_name, CAST(sum(available_quantity) AS BIGINT) AS units
  FROM base GROUP BY product_id, location_id, location_name
),
pair AS (
  SELECT d.product_id, d.variant_id, d.product_title, d.variant_title, d.sku, d.product_type, d.is_classics,
         d.location_id AS send_from_location_id, d.location_name AS send_from_location_name,
         d.available_quantity AS send_from_available_quantity, own.units AS send_from_style_available_quantity,
         t.location_id AS send_to_location_id, t.location_name AS send_to_location_name,
         t.units AS send_to_style_available_quantity, w.units AS warehouse_style_available_quantity
  FROM base AS d
  JOIN style_stock AS own ON d.product_id = own.product_id AND d.location_id = own.location_id
  JOIN style_stock AS w ON d.product_id = w.product_id AND w.location_name = 'Online / Warehouse'
  JOIN style_stock AS t ON d.product_id = t.product_id AND d.location_id <> t.location_id
  JOIN place AS target ON t.location_id = target.location_id
  WHERE d.can_send AND d.location_name NOT IN ('Fitzroy', 'Flinders Lane') AND d.available_quantity > 0
    AND own.units = 1 AND w.units <= 0 AND target.can_receive AND t.units > 1
    AND (d.location_name = 'Oxford St') = (t.location_name = 'Newtown')
    AND (d.location_name = 'Newtown') = (t.location_name = 'Oxford St')
    AND (t.location_name <> 'Smith St' OR d.denim_or_classics)
),
most AS (
  SELECT product_id, send_from_location_id, max(send_to_style_available_quantity) AS units
  FROM pair GROUP BY ALL
)"""

_CONSOLIDATION = """
SELECT pair.*, CAST(1 AS BIGINT) AS recommended_transfer_quantity, 'style_consolidation' AS recommendation_type,
       units AS highest_destination_style_quantity,
       count(*) OVER (PARTITION BY pair.product_id, pair.send_from_location_id) AS highest_destination_count
FROM pair JOIN most ON pair.product_id = most.product_id
                   AND pair.send_from_location_id = most.send_from_location_id
                   AND send_to_style_available_quantity = units
QUALIFY highest_destination_count = 1"""

MODEL_SQL = {
    "stg_products": with_ctes((PROD,), _STG_PRODUCTS),
    "stg_product_variants": with_ctes((PROD, VARIANT), _STG_VARIANTS),
    "stg_locations": with_ctes((LOC,), _STG_LOCATIONS),
    "stg_inventory_levels": with_ctes((LEVEL,), _STG_LEVELS),
    "stg_orders": with_ctes((LINES, ORD), _STG_ORDERS),
    "stg_order_lines": with_ctes((LINES, ORD, LINE), _STG_LINES),
    "stg_customers": with_ctes((CUST_VERSION,), _STG_CUSTOMERS),
    "fact_sales": with_ctes(SALES_CHAIN, _FACT_SALES),
    "dim_locations": with_ctes((LOC,), _DIM_LOCATIONS),
    "dim_products": with_ctes((*SALES_CHAIN, PROD), _DIM_PRODUCTS),
    "dim_customers": with_ctes((*SALES_CHAIN, CUST_VERSION), _DIM_CUSTOMERS),
    "fact_inventory": with_ctes(STOCK_CHAIN, _FACT_INVENTORY),
    "fact_daily_sales": with_ctes((LINES, ORD, LOC, _DAILY_EVENTS), _FACT_DAILY),
    "style_demand": with_ctes((*SALES_CHAIN, LOC, STYLE_DEMAND), _STYLE_DEMAND),
    "variant_demand": with_ctes(DEMAND_CHAIN, _VARIANT_DEMAND),
    "weeks_of_cover": with_ctes((*SALES_CHAIN, *STOCK_CHAIN), _WEEKS),
    "negative_stock": with_ctes(STOCK_CHAIN, _NEGATIVE),
    "negative_stock_summary": with_ctes(STOCK_CHAIN, _NEGATIVE_SUMMARY),
    "rotation_locations": with_ctes(ROTATION_CHAIN, _ROTATION_LOCATIONS),
    "rotation_products": with_ctes((PROD,), _ROTATION_PRODUCTS),
    "rotation_candidates": with_ctes(CANDIDATE_CHAIN, _CANDIDATES),
    "rotation_recommendations": with_ctes(CANDIDATE_CHAIN, _RECOMMENDATIONS),
    "rotation_report": with_ctes(CANDIDATE_CHAIN, _REPORT),
    "rotation_workbench": with_ctes(CANDIDATE_CHAIN, _WORKBENCH),
    "consolidation": with_ctes((*ROTATION_CHAIN, _CONSOLIDATION_CTES), _CONSOLIDATION),
}
