"""Queries for pages, envelopes, cursors, loads, checks and the whole refresh."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.flat_sql import (
    CUST_VERSION,
    LEVEL,
    LINES,
    LOC,
    ORD,
    PROD,
    SALES_CHAIN,
    STOCK_CHAIN,
    VARIANT,
    with_ctes,
)
from registry.models import MODEL_SQL
from registry.warehouse import open_warehouse, present
from stockflow.functions import safe_long
from stockflow.functions.dates import instant
from stockflow.operators import latest_by, upsert
from stockflow.plans.ingest import (
    IngestJob,
    ingest,
    inventory_item_ids,
    levels_of_known_items,
    pages_to_raw,
    record_run,
)
from stockflow.plans.models import MART_MODELS, MODELS, STAGING_MODELS, TABLE, StoredTables, with_display_position
from stockflow.plans.quality import quality_report
from stockflow.plans.refresh import run_daily_refresh, run_marts
from stockflow.session import prepare, scratch_path
from stockflow.sources import (
    CursorTable,
    TableStore,
    cap_pages,
    latest_cursor,
    page_items,
    read_pages,
    updated_since,
)
from stockflow.sources import feed
from stockflow.sources.files import folder_exists
from stockflow.streaming import stream_pages_to_raw

LOADING_QUERIES: dict = {}
LOADING_SQL: dict[str, str] = {}
PAGE_SIZE = 250
NOW = datetime(2001, 8, 1, 6)
EARLIER = datetime(2001, 7, 31, 6)


def query(sql: str | None = None):
    """Register the decorated function under its name, with SQL for the same result."""

    def register(function):
        LOADING_QUERIES[function.__name__] = function
        if sql is not None:
            LOADING_SQL[function.__name__] = sql.strip()
        return function

    return register


_landed: dict[tuple, str] = {}


def landed_customers(spark: SparkSession, folder: str) -> str:
    """Path of the landed customer pages, written once per warehouse."""
    warehouse = open_warehouse(spark, folder)
    key = (warehouse.store.root, "customer")
    if key not in _landed:
        path = warehouse.store.path("landing/customers")
        feed.landed_pages(feed.customer_documents(spark, folder), "customers", PAGE_SIZE).write.option("compression", "gzip").json(path)
        _landed[key] = path
    return _landed[key]


_PAGED = """
paged AS (
  SELECT *, (row_number() OVER (ORDER BY customer_id, version) - 1) // 250 + 1 AS page_no FROM cust_version
)"""


@query(with_ctes((CUST_VERSION, _PAGED), """
SELECT page_no, customer_id, customer_state FROM paged
"""))
def page_unnest(spark, folder):
    items = page_items(read_pages(prepare(spark), landed_customers(spark, folder)), "customers")
    return items.select(
        "page_no",
        safe_long(F.get_json_object("item", "$.id")).alias("customer_id"),
        F.get_json_object("item", "$.state").alias("customer_state"),
    )


@query(with_ctes((CUST_VERSION, _PAGED), """
SELECT page_no, count(*) AS item_count, min(customer_id) AS first_id, max(customer_id) AS last_id
FROM paged WHERE page_no <= 3 GROUP BY page_no
"""))
def page_cap(spark, folder):
    pages = cap_pages(read_pages(prepare(spark), landed_customers(spark, folder)), 3)
    items = page_items(pages, "customers").withColumn("id", safe_long(F.get_json_object("item", "$.id")))
    return items.groupBy("page_no").agg(
        F.count(F.lit(1)).alias("item_count"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(with_ctes((CUST_VERSION,), """
SELECT 'shop' AS source, 'customer' AS entity, CAST(customer_id AS VARCHAR) AS record_id,
       '2001-08-01 06:00:00' AS extracted_at, customer_state FROM cust_version
"""))
def ingest_envelope(spark, folder):
    pages = read_pages(prepare(spark), landed_customers(spark, folder))
    raw = pages_to_raw(pages, IngestJob("customer"), instant(NOW))
    return raw.select(
        "source",
        "entity",
        "record_id",
        F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss").alias("extracted_at"),
        F.get_json_object("payload", "$.state").alias("customer_state"),
    )


@query(with_ctes((CUST_VERSION, LOC, LINES, ORD), """
SELECT 'customer' AS entity, customer_id AS id, version = 1 AS is_newest, true AS has_phone_key, phone,
       CASE WHEN has_address THEN true END AS address_has_phone, CASE WHEN has_address THEN address_phone END AS address_phone,
       CASE WHEN has_address AND address_phone IS NOT NULL THEN 'STRING' END AS address_phone_kind FROM cust_version
UNION ALL SELECT 'location', location_id, true, true, CAST(location_id + 61390000000 AS VARCHAR), NULL, NULL, NULL FROM loc
UNION ALL SELECT 'order', order_id, newest, o_orderkey % 3 = 0,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey + 61700000000 AS VARCHAR) END, true,
       CAST(o_custkey + 61800000000 AS VARCHAR), 'STRING'
FROM ord CROSS JOIN (VALUES (true), (false)) AS two(newest) WHERE newest OR o_orderkey % 5 = 0
"""))
def phone_normalised(spark, folder):
    """Phones are text in the payloads of every entity, at any depth."""
    warehouse = open_warehouse(spark, folder)

    def phones(entity: str, table: str, address: str) -> DataFrame:
        path = f"$.{address}"
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("payload"), f"{path}.phone", "variant"))
        return warehouse[table].select(
            F.lit(entity).alias("entity"),
            safe_long(F.col("record_id")).alias("id"),
            (F.to_date("extracted_at") == F.lit("2001-08-01").cast("date")).alias("is_newest"),
            F.array_contains(F.json_object_keys("payload"), "phone").alias("has_phone_key"),
            F.get_json_object("payload", "$.phone").alias("phone"),
            F.array_contains(F.json_object_keys(F.get_json_object("payload", path)), "phone").alias("address_has_phone"),
            F.get_json_object("payload", f"{path}.phone").alias("address_phone"),
            F.when(kind != "VOID", kind).alias("address_phone_kind"),
        )

    customers = phones("customer", "raw_customers", "default_address")
    locations = phones("location", "raw_locations", "billing_address")
    return customers.union(locations).union(phones("order", "raw_orders", "billing_address"))


@query(with_ctes((LEVEL,), """
SELECT inventory_item_id || '-' || location_id AS record_id, 1 + CAST(older AS BIGINT) AS version_count
FROM (SELECT *, ((inventory_item_id - 1000000) // 10) % 10 = 0
             AND (CASE location_id WHEN 77 THEN 13 ELSE location_id END) % 3 = 0 AS older FROM level)
"""))
def composite_ids(spark, folder):
    raw = open_warehouse(spark, folder)["raw_inventory_levels"]
    return raw.groupBy("record_id").agg(F.count(F.lit(1)).alias("version_count"))


@query(with_ctes((CUST_VERSION,), """
SELECT customer_id, customer_state FROM cust_version WHERE customer_updated_at >= '2001-07-15 00:00:00'
"""))
def incremental_filter(spark, folder):
    items = page_items(read_pages(prepare(spark), landed_customers(spark, folder)), "customers")
    changed = updated_since(items, datetime(2001, 7, 15))
    return changed.select(
        safe_long(F.get_json_object("item", "$.id")).alias("customer_id"),
        F.get_json_object("item", "$.state").alias("customer_state"),
    )


@query(with_ctes((LINES, ORD), """
SELECT strftime(max(changed), '%Y-%m-%d %H:%M:%S') AS latest_cursor FROM (
  SELECT updated AS changed FROM ord UNION ALL SELECT created FROM ord WHERE o_orderkey % 5 = 0)
"""))
def latest_cursor_of_orders(spark, folder):
    return present(latest_cursor(open_warehouse(spark, folder)["raw_orders"]))


@query("""
SELECT 'customer-' || o_custkey AS job_name, 'o_orderdate' AS cursor_field,
       strftime(COALESCE(max(o_orderdate) FILTER (o_orderdate >= TIMESTAMP '2000-01-01'), max(o_orderdate)),
                '%Y-%m-%d %H:%M:%S') AS cursor_value
FROM orders GROUP BY o_custkey
""")
def state_upsert(spark, folder):
    orders = feed.flat_table(prepare(spark), folder, "orders").select(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("job_name"),
        F.lit("o_orderdate").alias("cursor_field"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
    )
    split = F.lit("2000-01-01").cast("timestamp")

    def cursors(rows: DataFrame) -> DataFrame:
        return rows.groupBy("job_name", "cursor_field").agg(F.max("at").alias("cursor_value"))

    saved, fresh = cursors(orders.where(F.col("at") < split)), cursors(orders.where(F.col("at") >= split))
    return present(upsert(saved, fresh, ["job_name"]))


@query(with_ctes((PROD, VARIANT), """
SELECT DISTINCT inventory_item_id FROM variant WHERE inventory_item_id IS NOT NULL
"""))
def inventory_ids(spark, folder):
    return inventory_item_ids(open_warehouse(spark, folder)["product_variants"])


@query(with_ctes((PROD, VARIANT, LEVEL), """
SELECT location_id, count(*) AS level_count FROM level
WHERE inventory_item_id IN (SELECT inventory_item_id FROM variant) GROUP BY location_id
"""))
def levels_of_items(spark, folder):
    warehouse = open_warehouse(spark, folder)
    known = levels_of_known_items(warehouse["raw_inventory_levels"], warehouse["product_variants"])
    newest = known.where(F.to_date("extracted_at") == F.lit("2001-08-01").cast("date"))
    return newest.groupBy(
        safe_long(F.get_json_object("payload", "$.location_id")).alias("location_id")
    ).agg(F.count(F.lit(1)).alias("level_count"))


@query("""
SELECT step, status, rows_loaded, rows_stored FROM (VALUES
  ('1 append', 'success', 1, 1), ('2 append again', 'success', 1, 2),
  ('3 only if empty', 'failed', 0, 2), ('4 replace', 'success', 1, 1)) AS v(step, status, loaded, stored)
  CROSS JOIN (SELECT count(*) AS n FROM orders)
  CROSS JOIN LATERAL (SELECT loaded * n AS rows_loaded, stored * n AS rows_stored)
""")
def append_replace(spark, folder):
    """Load dispositions and outcomes over the whole orders table."""
    store = TableStore(prepare(spark), scratch_path(spark, "loads"))
    orders = feed.flat_table(spark, folder, "orders")
    steps = []
    for step, disposition in (
        ("1 append", "append"),
        ("2 append again", "append"),
        ("3 only if empty", "empty"),
        ("4 replace", "truncate"),
    ):
        result = store.load("orders", orders, disposition)
        steps.append((step, result.status, result.rows_loaded, store.read("orders").count()))
    return spark.createDataFrame(
        steps, "step string, status string, rows_loaded bigint, rows_stored bigint"
    )


_QUALITY_SQL = """
SELECT 'fact_sales' AS model, 'order_line_id' AS "column", 'not_null' AS "check",
       count(*) FILTER (order_line_id IS NULL) AS failures FROM sale
UNION ALL SELECT 'fact_sales', 'order_id', 'not_null', count(*) FILTER (order_id IS NULL) FROM sale
UNION ALL SELECT 'fact_sales', 'net_sales', 'not_null', count(*) FILTER (net_sales IS NULL) FROM sale
UNION ALL SELECT 'fact_sales', 'order_line_id', 'unique', count(*) FROM (
  SELECT order_line_id FROM sale GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'fact_inventory_snapshot', c, 'not_null', n FROM (
  SELECT unnest(['inventory_level_key', 'inventory_item_id', 'location_id', 'variant_id', 'available_quantity']) AS c,
         unnest([count(*) FILTER (inventory_level_key IS NULL), count(*) FILTER (inventory_item_id IS NULL),
                 count(*) FILTER (location_id IS NULL), count(*) FILTER (variant_id IS NULL),
                 count(*) FILTER (available_quantity IS NULL)]) AS n FROM snapshot)
UNION ALL SELECT 'fact_inventory_snapshot', 'inventory_level_key', 'unique', count(*) FROM (
  SELECT inventory_level_key FROM snapshot GROUP BY 1 HAVING count(*) > 1)
"""


@query(with_ctes((*SALES_CHAIN, *STOCK_CHAIN), _QUALITY_SQL))
def quality_of_facts(spark, folder):
    return quality_report(open_warehouse(spark, folder), ["fact_sales", "fact_inventory_snapshot"])


_DAILY_MONEY = ("gross_sales", "discounts", "returns", "shipping_sales", "taxes", "total_sales")


@query(
    "WITH daily AS (" + MODEL_SQL["fact_daily_sales"] + "), c AS (" + MODEL_SQL["dim_customers"]
    + "), p AS (" + MODEL_SQL["dim_products"] + ")\n"
    + "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'not_null' AS \"check\", "
        f"count(*) FILTER ({column} IS NULL) AS failures FROM {table}"
        for model, table, columns in (
            ("fact_daily_sales", "daily", ("trading_date", "location_name", *_DAILY_MONEY)),
            ("dim_customers", "c", ("customer_id",)),
            ("dim_products", "p", ("product_id",)),
        )
        for column in columns
    )
    + "\nUNION ALL SELECT 'dim_customers', 'customer_id', 'unique', count(*) - count(DISTINCT customer_id) FROM c"
    + "\nUNION ALL SELECT 'dim_products', 'product_id', 'unique', count(*) - count(DISTINCT product_id) FROM p"
)
def quality_of_dimensions(spark, folder):
    return quality_report(
        open_warehouse(spark, folder), ["fact_daily_sales", "dim_customers", "dim_products"]
    )


_REFRESHED = {
    "products": "stg_products",
    "product_variants": "stg_product_variants",
    "locations": "stg_locations",
    "inventory_levels": "stg_inventory_levels",
    "orders": "stg_orders",
    "order_lines": "stg_order_lines",
    "customers": "stg_customers",
    "fact_inventory_snapshot": "fact_inventory",
    "style_location_demand": "style_demand",
    "variant_location_demand": "variant_demand",
    "store_rotation_locations": "rotation_locations",
    "store_rotation_products": "rotation_products",
    "store_rotation_candidates": "rotation_candidates",
    "store_rotation_recommendations": "rotation_recommendations",
    "store_rotation_report": "rotation_report",
    "store_rotation_workbench": "rotation_workbench",
    "style_consolidation_candidates": "consolidation",
}


# levels are only loaded for the items of known variants
_REFRESHED_SQL = {
    "inventory_levels": with_ctes(
        (PROD, VARIANT, LEVEL), "SELECT * FROM level WHERE inventory_item_id IN (SELECT inventory_item_id FROM variant)"
    ),
}
# rows that each run loads, and what the first one stages
_RUNS_SQL = with_ctes((PROD, VARIANT, LEVEL, LOC, LINES, ORD), """
SELECT run, step, 'success' AS status, rows_written FROM (
  SELECT 1 AS run, 'raw_products' AS step, count(*) AS rows_written FROM prod WHERE product_id % 4 = 0
  UNION ALL SELECT 1, 'products', count(*) FROM prod WHERE product_id % 4 = 0
  UNION ALL SELECT 1, 'raw_orders', count(*) FROM ord WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 1, 'orders', count(*) FROM ord WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 1, 'raw_customers', count(*) FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT 1, 'customers', count(*) FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT 1, unnest(['raw_locations', 'raw_inventory_levels', 'locations', 'inventory_levels',
                              'product_variants', 'order_lines']), 0
  UNION ALL SELECT 2, 'raw_products', count(*) FROM prod
  UNION ALL SELECT 2, 'raw_locations', count(*) FROM loc
  UNION ALL SELECT 2, 'raw_orders', count(*) FROM ord
  UNION ALL SELECT 2, 'raw_customers', count(*) FROM customer
  UNION ALL SELECT 2, 'raw_inventory_levels', count(*) FROM level
            WHERE inventory_item_id IN (SELECT inventory_item_id FROM variant))
""")


def landed(spark: SparkSession, folder: str, root: str, newest: bool) -> dict[str, DataFrame]:
    """The pages of every entity of one delivery, written under ``root``."""
    pages = {}
    for entity, (_, field) in feed.PAGED_DOCUMENTS.items():
        path = f"{root}/{field}"
        feed.delivered_pages(spark, folder, entity, newest, PAGE_SIZE).write.option("compression", "gzip").json(path)
        pages[entity] = read_pages(spark, path)
    return pages


@query(
    f"SELECT * FROM ({_RUNS_SQL})\nUNION ALL "
    + "\nUNION ALL ".join(
        f"SELECT 2 AS run, '{model.name}' AS step, 'success' AS status, count(*) AS rows_written FROM ("
        + _REFRESHED_SQL.get(model.name, MODEL_SQL[_REFRESHED.get(model.name, model.name)]) + ")"
        for model in (*STAGING_MODELS, *MART_MODELS)
        if model.kind == TABLE
    )
)
def refresh_summary(spark, folder):
    """The whole daily job twice, from landed pages to checked marts: first over the older
    versions of all records, then over the newest ones on top of them."""
    store = TableStore(prepare(spark), scratch_path(spark, "refresh"))
    tables = StoredTables(store, feed.FEED_CONFIG)
    rows = []
    for run, now in ((1, EARLIER), (2, NOW)):
        outcome = run_daily_refresh(landed(spark, folder, store.path(f"landing/{run}"), run == 2), store, tables, now)
        if outcome.failed_stage:
            raise RuntimeError(f"{outcome.failed_stage}: {outcome.error_message}")
        stages = (outcome.staging, outcome.marts) if run == 2 else (outcome.staging,)
        results = [*outcome.ingested.values(), *(r for stage in stages for r in stage.results)]
        rows += [(run, r.table, r.status, r.rows_loaded) for r in results if not r.table.startswith("negative_stock")]
    return spark.createDataFrame(rows, "run int, step string, status string, rows_written bigint")


_ORDER_COUNTS = "count(*) FILTER (o_orderkey % 5 = 0) AS older, count(*) AS newest"


@query(with_ctes((LINES, ORD), f"""
SELECT step, status, rows_loaded, strftime(cursor_value, '%Y-%m-%d %H:%M:%S') AS cursor_value FROM (
  SELECT {_ORDER_COUNTS}, max(created) FILTER (o_orderkey % 5 = 0) AS first_at, max(updated) AS last_at FROM ord)
  CROSS JOIN LATERAL (VALUES
    ('1 older versions', 'success', older, first_at), ('2 lost page', 'failed', 0, first_at),
    ('3 no pages', 'success', 0, first_at), ('4 newest versions', 'success', newest, last_at),
    ('5 all versions again', 'success', (SELECT count(*) FROM ord WHERE updated >= (SELECT max(updated) FROM ord)), last_at)
  ) AS v(step, status, rows_loaded, cursor_value)
"""))
def cursor_roundtrip(spark, folder):
    """The saved cursor limits the next load, includes its own instant, and only moves after
    a load that succeeded and brought something."""
    store = TableStore(prepare(spark), scratch_path(spark, "cursor"))
    for name, is_newest in (("older", False), ("newest", True)):
        pages = feed.delivered_pages(spark, folder, "order", is_newest, PAGE_SIZE)
        pages.write.option("compression", "gzip").json(store.path(f"landing/{name}"))
    older, newest = (read_pages(spark, store.path(f"landing/{name}")) for name in ("older", "newest"))
    lost = older.withColumn("body", F.raise_error(F.lit("page lost")).cast("string"))
    state, job, steps = CursorTable(store), IngestJob("order"), []
    for step, pages in (
        ("1 older versions", older),
        ("2 lost page", lost),
        ("3 no pages", older.where("false")),
        ("4 newest versions", newest),
        ("5 all versions again", older.union(newest)),
    ):
        result = ingest(pages, job, store, state, NOW)
        steps.append((step, result.status, result.rows_loaded, str(state.get(job.name))))
    return spark.createDataFrame(steps, "step string, status string, rows_loaded bigint, cursor_value string")


@query(with_ctes((CUST_VERSION,), """
SELECT 'shop-customers' AS job_name, status, rows_processed, message IS NOT NULL AS has_message FROM (
  SELECT 'success' AS status, count(*) AS rows_processed, NULL AS message FROM cust_version
  UNION ALL SELECT 'failed', 0, 'lost')
"""))
def run_history(spark, folder):
    """Every load is recorded, with its rows or the reason why it failed."""
    pages = read_pages(prepare(spark), landed_customers(spark, folder))
    lost = pages.withColumn("body", F.raise_error(F.lit("page lost")).cast("string"))
    store = TableStore(spark, scratch_path(spark, "history"))
    job, state = IngestJob("customer"), CursorTable(store)
    for source in (pages, lost):
        record_run(store, job.name, EARLIER, NOW, ingest(source, job, store, state, NOW))
    return store.read("job_history").select(
        "job_name", "status", "rows_processed", F.col("message").isNotNull().alias("has_message")
    )


class _Spoiled(StoredTables):
    """Tables of a warehouse, but some order lines have no price; marts go to a store of their own."""

    def __init__(self, store: TableStore, warehouse: StoredTables):
        super().__init__(store, warehouse.cfg)
        self.warehouse = warehouse

    def __getitem__(self, name: str) -> DataFrame:
        if name not in {model.name for model in STAGING_MODELS}:
            return super().__getitem__(name)
        rows = self.warehouse[name]
        if name == "order_lines":
            lost = F.col("order_line_id") % 7 == 0
            rows = rows.withColumn("unit_price", F.when(~lost, F.col("unit_price")))
        return rows


@query(with_ctes(SALES_CHAIN, """
SELECT status, failed_step, 'fact_sales.net_sales not_null: ' || count(*) AS message, 1 AS steps_run
FROM (SELECT 'failed' AS status, 'fact_sales' AS failed_step FROM line WHERE order_line_id % 7 = 0)
GROUP BY status, failed_step
"""))
def failed_check_stops(spark, folder):
    """A check that fails ends the build of the marts: nothing after it is built."""
    warehouse = open_warehouse(spark, folder)
    store = TableStore(spark, scratch_path(spark, "spoiled"))
    stage = run_marts(_Spoiled(store, warehouse), ["fact_sales", "dim_products", "dim_customers"])
    row = (stage.status, stage.failed_step, stage.error_message, len(stage.results))
    return spark.createDataFrame([row], "status string, failed_step string, message string, steps_run int")


class _Second(_Spoiled):
    """A second run: only every second order line is there, and some customers lost their id."""

    def __getitem__(self, name: str) -> DataFrame:
        if name == "order_lines":
            return self.warehouse[name].where(F.col("order_line_id") % 2 == 0)
        if name == "customers":
            rows = self.warehouse[name]
            return rows.withColumn("customer_id", F.when(F.col("customer_id") % 5 != 0, F.col("customer_id")))
        return super().__getitem__(name)


class _First(_Spoiled):
    """A first run over the whole warehouse."""

    def __getitem__(self, name: str) -> DataFrame:
        staged = name in {model.name for model in STAGING_MODELS}
        return self.warehouse[name] if staged else StoredTables.__getitem__(self, name)


_KEPT = {"fact_sales": "order_line_id", "dim_products": "product_id", "dim_customers": "customer_id"}


@query(
    "\nUNION ALL ".join(
        f"SELECT 'failed' AS second_run, 'dim_customers' AS failed_step, '{model}' AS model, count(*) AS row_count, "
        f"CAST(sum({key}) AS BIGINT) AS key_sum FROM ({MODEL_SQL[model]})"
        for model, key in _KEPT.items()
    )
)
def failed_check_keeps_old(spark, folder):
    """After a run whose last check fails, every table still shows the run before, those
    that passed their own checks included."""
    warehouse = open_warehouse(spark, folder)
    store = TableStore(spark, scratch_path(spark, "published"))
    first = run_marts(_First(store, warehouse), list(_KEPT))
    if not first.ok:
        raise RuntimeError(first.error_message)
    second = run_marts(_Second(store, warehouse), list(_KEPT))
    found = None
    for model, key in _KEPT.items():
        rows = store.read(model).agg(F.count(F.lit(1)).alias("row_count"), F.sum(key).cast("bigint").alias("key_sum"))
        rows = rows.select(
            F.lit(second.status).alias("second_run"),
            F.lit(second.failed_step).alias("failed_step"),
            F.lit(model).alias("model"),
            "row_count",
            "key_sum",
        )
        found = rows if found is None else found.union(rows)
    return found


@query(
    "WITH report AS (" + MODEL_SQL["negative_stock"] + """)
SELECT row_number() OVER (ORDER BY location_name NULLS FIRST, available_quantity NULLS FIRST, product_title NULLS FIRST,
                          variant_title NULLS FIRST, sku NULLS FIRST, location_id) AS position,
       location_name, available_quantity, product_title, variant_title FROM report
"""
)
def display_order(spark, folder):
    """The place of every row of a report in the order in which it is read."""
    report = open_warehouse(spark, folder).model("negative_stock_report")
    placed = with_display_position("negative_stock_report", report, ("sku", "location_id"))
    return placed.select("position", "location_name", "available_quantity", "product_title", "variant_title")


@query(with_ctes((CUST_VERSION,), """
SELECT CAST(customer_id AS VARCHAR) AS record_id, customer_state,
       strftime(CAST(customer_updated_at AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS updated_at FROM cust_version
"""))
def stream_ingest(spark, folder):
    """Landed pages read as a stream of files into the raw table, until none is left."""
    landing = landed_customers(spark, folder)
    store = TableStore(prepare(spark), scratch_path(spark, "stream"))
    stream_pages_to_raw(spark, landing, store, IngestJob("customer")).awaitTermination()
    raw = store.read("raw_customers")
    return raw.select(
        "record_id",
        F.get_json_object("payload", "$.state").alias("customer_state"),
        F.get_json_object("payload", "$.updated_at").alias("updated_at"),
    )


@query(with_ctes((CUST_VERSION,), """
SELECT first_load, CAST(customer_id AS VARCHAR) AS record_id, customer_state
FROM cust_version CROSS JOIN (VALUES ('stream'), ('batch')) AS two(first_load)
"""))
def stream_then_batch(spark, folder):
    """Half of the pages streamed and half loaded as a batch, into one table, in both orders."""
    every = read_pages(prepare(spark), landed_customers(spark, folder))
    found = None
    for first in ("stream", "batch"):
        store, job = TableStore(spark, scratch_path(spark, f"{first}-first")), IngestJob("customer")
        every.where("page_no % 2 = 0").write.option("compression", "gzip").json(store.path("landing"))
        for way in (first, "batch" if first == "stream" else "stream"):
            if way == "stream":
                stream_pages_to_raw(spark, store.path("landing"), store, job).awaitTermination()
            else:
                ingest(every.where("page_no % 2 = 1"), job, store, CursorTable(store), NOW)
        raw = store.read(job.table).select(
            F.lit(first).alias("first_load"), "record_id", F.get_json_object("payload", "$.state").alias("customer_state")
        )
        found = raw if found is None else found.union(raw)
    return found


@query(MODEL_SQL["stg_products"])
def staged_by_merge(spark, folder):
    """Products staged from two deliveries: each one is ranked alone and merged into the key
    buckets that it touches, where the latest version of a product stays. The newer comes first,
    so that a late delivery of older versions must not win."""
    raw = open_warehouse(spark, folder)["raw_products"]
    store = TableStore(spark, scratch_path(spark, "merged"))
    newer = F.to_date("extracted_at") == F.lit(NOW).cast("date")

    def latest(old: DataFrame, new: DataFrame) -> DataFrame:
        order = [F.col("payload").asc(), F.col("source").asc(), F.col("entity").asc()]
        return latest_by(old.unionByName(new), ["product_key"], [F.col("extracted_at").desc()], order)

    for delivery in (raw.where(newer), raw.where(~newer)):
        staged = MODELS["products"].build({"raw_products": delivery}, feed.FEED_CONFIG)
        result = store.merge("products", staged, ["product_key"], latest)
        if not result.ok:
            raise RuntimeError(result.error_message)
    return present(store.read("products"))


class _Failing(TableStore):
    """A store whose commits of some batches fail the first time: rows written, number not."""

    def _commit(self, change):
        if not folder_exists(self.path("failed-once")):
            self.spark.range(1).write.parquet(self.path("failed-once"))
            raise OSError("commit lost")
        super()._commit(change)


@query(with_ctes((CUST_VERSION,), """
SELECT true AS first_run_failed, CAST(customer_id AS VARCHAR) AS record_id, count(*) AS raw_rows
FROM cust_version GROUP BY customer_id
"""))
def stream_after_failure(spark, folder):
    """A stream that loses the commit of a batch is started again: every raw row is there once."""
    landing = landed_customers(spark, folder)
    store, job, failed = _Failing(prepare(spark), scratch_path(spark, "failing")), IngestJob("customer"), False
    try:
        stream_pages_to_raw(spark, landing, store, job, files_per_batch=1).awaitTermination()
    except StreamingQueryException:
        failed = True
    stream_pages_to_raw(spark, landing, store, job).awaitTermination()
    counted = store.read(job.table).groupBy("record_id").agg(F.count(F.lit(1)).alias("raw_rows"))
    return counted.select(F.lit(failed).alias("first_run_failed"), "record_id", "raw_rows")
