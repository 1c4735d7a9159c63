"""Building blocks in SQL: the shop's documents, stated over the flat tables.

Written from the rules of the feed, without JSON, versions or Spark.
"""

from __future__ import annotations

LOCATION_NAMES = (
    "['Online / Warehouse', 'Flinders Lane', 'Fitzroy', 'Newtown', 'Smith St', 'Melbourne Outlet', "
    "'Claremont', 'Paddington', 'Oxford St', 'Wellington', 'James St', 'Spring1883', "
    "'Faulty Land', 'Sparehouse']"
)
SALES_NAMES = (
    "['Warehouse', 'Melbourne', 'Fitzroy', 'Newtown', 'Smith St', 'Melbourne Outlet', 'Claremont', "
    "'Paddington', 'Oxford St', 'Wellington', 'James St', 'Spring1883']"
)
AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"

LOC = f"""
loc AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id,
         COALESCE({LOCATION_NAMES}[n_nationkey + 1], n_name) AS location_name,
         {SALES_NAMES}[n_nationkey + 1] AS sales_location_name,
         n_nationkey || ' High Street' AS address1,
         CASE WHEN n_nationkey % 3 = 0 THEN 'Level ' || n_nationkey END AS address2,
         n_name AS city, r_name AS province, substr(r_name, 1, 2) AS province_code,
         n_name AS country, substr(n_name, 1, 2) AS country_code,
         lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS postcode,
         CASE WHEN n_nationkey <> 24 THEN n_nationkey < 14 END AS is_active,
         n_nationkey % 5 = 0 AS is_legacy
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

PROD = """
prod AS (
  SELECT p_partkey AS product_id, CAST(p_partkey AS VARCHAR) AS product_key,
         p_name AS product_title, replace(p_name, ' ', '-') AS handle, p_brand AS vendor,
         CASE WHEN p_type = 'PROMO' THEN 'Denim' ELSE p_type END AS product_type,
         CASE WHEN p_size > 5 THEN 'active' ELSE 'draft' END AS status,
         'all' || CASE WHEN p_partkey % 2 = 0 THEN ', Season_AW26' ELSE '' END
               || CASE WHEN p_partkey % 11 = 0 THEN ', classics' ELSE '' END
               || CASE WHEN p_partkey % 13 = 0 THEN ', aw26 rotation hold' ELSE '' END
               || ', end' AS tags,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price
  FROM part
)"""

VARIANT = """
variant AS (
  SELECT product_id, product_key, product_id * 10 + v AS variant_id, v,
         CASE WHEN (product_id * 10 + v) % 37 <> 0 THEN 'SKU-' || (product_id * 10 + v) END AS sku,
         'Size ' || v AS variant_title,
         CASE WHEN product_id % 3 = 0
              THEN '93' || lpad(CAST(product_id * 10 + v AS VARCHAR), 11, '0') END AS barcode,
         list_price + v AS price,
         CASE WHEN product_id % 7 <> 0 THEN list_price + 10 END AS compare_at_price,
         product_id % 50 + v AS inventory_quantity,
         product_id * 10 + v + 1000000 AS inventory_item_id,
         product_title, vendor, product_type, status AS product_status
  FROM prod CROSS JOIN (VALUES (0), (1)) AS two(v)
  WHERE product_id % 101 <> 100
)"""

LEVEL = """
level AS (
  SELECT p * 10 + v + 1000000 AS inventory_item_id,
         CASE WHEN spot = 13 AND p % 53 = 0 THEN 77 ELSE spot END AS location_id,
         CASE WHEN p % 29 = 0 AND spot = 5 THEN NULL
              WHEN spot = 0 THEN (p * 5 + v * 2 + p // 7) % 4 - 2
              ELSE (p * (spot + 3) + v * (2 + spot % 3) + (p // 6) * spot + spot) % 5 - 1
         END AS available_quantity
  FROM (SELECT p_partkey AS p FROM part)
       CROSS JOIN (VALUES (0), (1)) AS two(v)
       CROSS JOIN (SELECT unnest(range(14)) AS spot)
)"""

LINES = """
typed AS (
  SELECT *,
         l_orderkey + 1000000000000 * (row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus, l_shipdate) - 1) AS order_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS units,
         CASE WHEN l_partkey % 19 = 0 THEN NULL
              WHEN l_linenumber % 2 = 1 THEN l_partkey % 200 ELSE l_partkey END AS product
  FROM lineitem
),
item AS (
  SELECT *,
         CAST(round(price * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS discount,
         CAST(round(price * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax,
         CAST(price * units AS DECIMAL(28,2)) AS gross,
         product * 10 + l_suppkey % 2 AS variant_no
  FROM typed
)"""

ORD = f"""
doc AS (
  SELECT l_orderkey, order_id, sum(gross - discount) AS subtotal, sum(discount) AS discounts, sum(tax) AS taxes
  FROM item GROUP BY l_orderkey, order_id
),
ord AS (
  SELECT COALESCE(order_id, o_orderkey) AS order_id, o_orderkey, o_custkey, '#' || o_orderkey AS order_name,
         CASE WHEN o_custkey % 17 = 0 THEN NULL
              WHEN o_orderkey % 2 = 0 THEN 'cust' || o_custkey || '@example.com'
              ELSE 'CUST' || o_custkey || '@Example.com' END AS customer_email,
         CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
         COALESCE(subtotal, 0) AS subtotal, COALESCE(discounts, 0) AS discounts, COALESCE(taxes, 0) AS taxes,
         CASE WHEN order_id <> o_orderkey OR o_orderkey % 3 = 0 THEN 0.00
              WHEN o_orderkey % 3 = 1 THEN 9.95 ELSE 10.00 END AS shipping,
         CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 97 = 5 THEN 'Popup'
              ELSE {SALES_NAMES}[CAST(o_custkey % 12 AS INT) + 1] END AS sales_location_name,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INT)) AS created,
         TIMESTAMP '2001-08-02 00:00:00' + to_days(CAST(o_orderkey % 5 AS INT)) AS updated,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN CAST(o_orderdate AS TIMESTAMP)
           + to_hours(CAST(o_orderkey % 24 AS INT)) + to_days(1) END AS cancelled
  FROM orders LEFT JOIN doc ON o_orderkey = l_orderkey
)"""

LINE = """
line AS (
  SELECT ord.order_id, order_name, l_orderkey * 100 + l_linenumber AS order_line_id,
         product AS product_id, variant_no AS variant_id,
         CASE WHEN product IS NOT NULL THEN 'SKU-' || variant_no
              WHEN l_suppkey % 2 = 0 THEN '' ELSE 'PART-' || l_partkey END AS sku,
         'Style ' || (l_partkey % 200) AS product_name, 'Size ' || (l_suppkey % 2) AS variant_title,
         'Supplier ' || (l_suppkey % 10) AS vendor,
         CASE WHEN product IS NOT NULL THEN 'product'
              WHEN l_suppkey % 2 = 0 THEN 'non_product_item' ELSE 'sku_only' END AS product_reference_status,
         units AS quantity, price AS unit_price, discount AS total_discount,
         created AS order_created_at, updated AS order_updated_at,
         customer_email, sales_location_name, fulfillment_status
  FROM item JOIN ord ON item.order_id = ord.order_id
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey * 100 + l_linenumber
    ORDER BY updated DESC, ord.order_id, product NULLS FIRST, variant_no NULLS FIRST,
             units, price, discount) = 1
),
sale AS (
  SELECT *, unit_price * quantity - total_discount AS net_sales FROM line
)"""

CUST_VERSION = """
cust_version AS (
  SELECT c_custkey AS customer_id, version,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              WHEN c_custkey % 50 = 49 THEN 'cust' || (c_custkey - 1) || '@example.com'
              ELSE 'cust' || c_custkey || '@example.com' END AS email,
         c_name AS first_name,
         CASE c_custkey % 3 WHEN 0 THEN ' '
              WHEN 1 THEN 'Family' || (c_custkey % 100) || chr(160) END AS last_name,
         CASE c_custkey % 3 WHEN 1 THEN c_name || ' Family' || (c_custkey % 100) ELSE c_name END AS full_name,
         CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey + 61400000000 AS VARCHAR) END AS phone,
         CASE version WHEN 1 THEN 'enabled' ELSE 'invited' END AS customer_state,
         CASE WHEN c_custkey % 23 <> 0 THEN 'vip' || (c_custkey % 3) END AS tags,
         'AUD' AS currency, c_custkey % 20 AS orders_count,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS total_spent,
         CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 2 = 0 END AS verified_email,
         c_custkey % 9 = 0 AS tax_exempt,
         CASE c_custkey % 2 WHEN 0 THEN 'subscribed' ELSE 'not_subscribed' END AS consent,
         CASE WHEN c_custkey % 4 = 0 THEN '2000-05-05 05:05:05' END AS consent_at,
         c_custkey % 5 <> 0 AS by_email,
         CASE version WHEN 1 THEN '2001-07-15 00:00:00' ELSE '2001-06-15 00:00:00' END AS customer_updated_at,
         c_custkey * 7 AS last_order_id, '#' || (c_custkey * 7) AS last_order_name,
         c_custkey % 8 <> 0 AS has_address,
         'Country ' || c_nationkey AS country, 'C' || c_nationkey AS country_code,
         c_mktsegment AS province, substr(c_mktsegment, 1, 3) AS province_code,
         'City ' || (c_custkey % 100) AS city, lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS postcode,
         CASE WHEN c_custkey % 16 <> 1 THEN CAST(c_custkey + 61400000000 AS VARCHAR) END AS address_phone
  FROM customer CROSS JOIN (VALUES (0), (1)) AS two(version)
  WHERE version = 1 OR c_custkey % 10 = 0
)"""

SNAPSHOT = """
snapshot AS (
  SELECT level.inventory_item_id || '-' || level.location_id AS inventory_level_key,
         level.location_id, location_name, sales_location_name, city, level.inventory_item_id,
         product_id, variant_id, product_title, variant_title, sku, vendor, product_type,
         COALESCE(available_quantity, 0) AS available_quantity, product_status
  FROM level JOIN variant ON level.inventory_item_id = variant.inventory_item_id
             JOIN loc ON level.location_id = loc.location_id
)"""

STYLE_DEMAND = f"""
style_demand AS (
  SELECT product_id, location_name,
         CAST(sum(CASE WHEN order_created_at >= {AS_OF} - INTERVAL 28 DAY THEN quantity ELSE 0 END) AS BIGINT)
           AS style_units_4_weeks,
         CAST(sum(CASE WHEN order_created_at >= {AS_OF} - INTERVAL 84 DAY THEN quantity ELSE 0 END) AS BIGINT)
           AS style_units_12_weeks,
         max(order_created_at) AS last_sale_at
  FROM sale JOIN loc ON sale.sales_location_name = loc.sales_location_name
  GROUP BY product_id, location_name
),
style_score AS (
  SELECT *, CAST(style_units_4_weeks AS DOUBLE) / 4 + CAST(style_units_12_weeks AS DOUBLE) / 12 AS demand_score
  FROM style_demand
)"""

DEMAND = f"""
variant_sales AS (
  SELECT variant_id, sales_location_name,
         CAST(sum(CASE WHEN order_created_at >= {AS_OF} - INTERVAL 28 DAY THEN quantity ELSE 0 END) AS BIGINT) AS u4,
         CAST(sum(CASE WHEN order_created_at >= {AS_OF} - INTERVAL 84 DAY THEN quantity ELSE 0 END) AS BIGINT) AS u12,
         min(order_created_at) AS first_at, max(order_created_at) AS last_at
  FROM sale WHERE sales_location_name IS NOT NULL GROUP BY variant_id, sales_location_name
),
warehouse AS (
  SELECT variant_id, CAST(sum(available_quantity) AS BIGINT) AS units
  FROM snapshot WHERE location_name = 'Online / Warehouse' GROUP BY variant_id
),
demand AS (
  SELECT s.*, COALESCE(u4, 0) AS units_sold_4_weeks, COALESCE(u12, 0) AS units_sold_12_weeks,
         COALESCE(style_units_4_weeks, 0) AS style_units_sold_4_weeks,
         COALESCE(style_units_12_weeks, 0) AS style_units_sold_12_weeks,
         COALESCE(demand_score, 0) AS style_demand_score, first_at, last_at,
         COALESCE(units, 0) AS warehouse_available_quantity
  FROM snapshot AS s
  LEFT JOIN variant_sales AS vs ON s.variant_id = vs.variant_id AND s.sales_location_name = vs.sales_location_name
  LEFT JOIN warehouse AS w ON s.variant_id = w.variant_id
  LEFT JOIN style_score AS sc ON s.product_id = sc.product_id AND s.location_name = sc.location_name
)"""

ROTATION_BASE = """
season AS (
  SELECT product_id, regexp_matches(lower(tags), '(^|,\\s*)classics(\\s*,|$)') AS is_classics
  FROM prod
  WHERE regexp_matches(lower(tags), '(^|,\\s*)season_aw26(\\s*,|$)')
    AND NOT regexp_matches(lower(tags), '(^|,\\s*)aw26 rotation')
    AND NOT regexp_matches(lower(product_title), '\\brings?\\b')
),
place AS (
  SELECT location_id, location_name,
         location_name NOT IN ('Online / Warehouse', 'Faulty Land', 'Sparehouse', 'Melbourne Outlet',
                               'Spring1883', 'Smith St', 'Paddington') AS can_send,
         location_name NOT IN ('Claremont', 'Wellington', 'James St', 'Paddington', 'Online / Warehouse',
                               'Faulty Land', 'Sparehouse', 'Melbourne Outlet', 'Spring1883') AS can_receive,
         CAST(CASE location_name WHEN 'Flinders Lane' THEN 100 WHEN 'Fitzroy' THEN 95 WHEN 'Smith St' THEN 90
                                 WHEN 'Newtown' THEN 85 WHEN 'Oxford St' THEN 80 ELSE 0 END AS BIGINT) AS priority
  FROM loc
),
base AS (
  SELECT d.*, can_send, can_receive, priority, is_classics,
         is_classics OR contains(upper(product_type), 'DENIM') AS denim_or_classics
  FROM demand AS d JOIN place ON d.location_id = place.location_id
                   JOIN season ON d.product_id = season.product_id
)"""

CANDIDATE = """
move AS (
  SELECT r.variant_id, r.product_id, r.product_title, r.variant_title, r.sku,
         s.location_id AS send_from_location_id, s.location_name AS send_from_location_name,
         s.available_quantity AS send_from_available_quantity,
         s.style_units_sold_12_weeks AS send_from_style_units_12_weeks,
         s.style_demand_score AS send_from_style_demand_score,
         r.location_id AS send_to_location_id, r.location_name AS send_to_location_name,
         r.available_quantity AS send_to_available_quantity,
         r.style_units_sold_12_weeks AS send_to_style_units_12_weeks,
         r.style_demand_score AS send_to_style_demand_score, r.priority AS send_to_rotation_priority,
         r.warehouse_available_quantity,
         CASE WHEN r.location_name IN ('Oxford St', 'Newtown') OR r.available_quantity = 1 THEN 1
              ELSE least(s.available_quantity, 2) END AS recommended_transfer_quantity,
         CAST(CASE s.location_name WHEN 'Newtown' THEN 1 WHEN 'Oxford St' THEN 2 WHEN 'Wellington' THEN 3
              WHEN 'Claremont' THEN 3 WHEN 'James St' THEN 3 WHEN 'Flinders Lane' THEN 4 WHEN 'Fitzroy' THEN 4
              ELSE 99 END AS BIGINT) AS donor_tier,
         r.style_demand_score - s.style_demand_score AS style_demand_gap,
         r.style_demand_score * 20 - s.style_demand_score * 5 + r.priority + 75 AS rotation_score
  FROM base AS r JOIN base AS s ON r.variant_id = s.variant_id AND r.location_id <> s.location_id
  WHERE r.can_receive AND r.available_quantity < 2 AND r.warehouse_available_quantity <= 0
    AND s.can_send AND s.available_quantity > 0
    -- Oxford St and Newtown trade with each other only, and into an empty shelf only
    AND (s.location_name = 'Oxford St') = (r.location_name = 'Newtown')
    AND (s.location_name = 'Newtown') = (r.location_name = 'Oxford St')
    AND (r.location_name NOT IN ('Oxford St', 'Newtown') OR r.available_quantity = 0)
    AND (r.location_name <> 'Oxford St'
         OR (s.available_quantity >= 2 AND r.style_demand_score > s.style_demand_score))
    -- Smith St takes denim and classics only
    AND (r.location_name <> 'Smith St' OR r.denim_or_classics)
    -- Flinders Lane and Fitzroy give to each other and Smith St, and only on strong grounds
    AND (s.location_name NOT IN ('Flinders Lane', 'Fitzroy')
         OR (r.location_name IN ('Flinders Lane', 'Fitzroy', 'Smith St') AND r.location_name <> s.location_name
             AND s.available_quantity > 2 AND r.available_quantity = 0
             AND r.style_demand_score > s.style_demand_score))
),
candidate AS (
  SELECT *,
         row_number() OVER (PARTITION BY variant_id, send_to_location_id
           ORDER BY donor_tier, rotation_score DESC, send_from_style_demand_score, send_from_location_name,
                    send_from_location_id) AS candidate_rank,
         row_number() OVER (PARTITION BY variant_id, send_from_location_id
           ORDER BY send_to_available_quantity, rotation_score DESC, send_to_style_units_12_weeks DESC,
                    send_to_rotation_priority DESC, send_to_location_name, send_to_location_id) AS donor_rank
  FROM move
)"""

SALES_CHAIN = (LINES, ORD, LINE)
STOCK_CHAIN = (LOC, PROD, VARIANT, LEVEL, SNAPSHOT)
DEMAND_CHAIN = (*SALES_CHAIN, *STOCK_CHAIN, STYLE_DEMAND, DEMAND)
ROTATION_CHAIN = (*DEMAND_CHAIN, ROTATION_BASE)
CANDIDATE_CHAIN = (*ROTATION_CHAIN, CANDIDATE)


def with_ctes(ctes: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select.strip()


def text_of(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def melbourne_date(ts: str) -> str:
    return f"CAST(CAST(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Melbourne' AS DATE) AS VARCHAR)"


def money(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(28,2)) AS DOUBLE)"
