"""Queries for single operators and functions, over whole flat tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.flat_sql import (
    CANDIDATE_CHAIN,
    CUST_VERSION,
    LINES,
    ORD,
    PROD,
    melbourne_date,
    with_ctes,
)
from registry.warehouse import open_warehouse, present
from stockflow.functions import (
    days_before,
    days_between,
    extract_first,
    has_tag,
    json_list,
    local_date,
    parse_payload,
    safe_bool,
    safe_divide,
    safe_long,
    safe_money,
    safe_ts,
    trim_blanks,
    utc_date,
)
from stockflow.functions.dates import instant
from stockflow.functions.text import matches
from stockflow.operators import (
    explode_json_array,
    global_rank,
    latest_by,
    pivot_fixed,
    unique_winner,
    windowed_units,
)
from stockflow.session import prepare
from stockflow.sources.feed import flat_table

OPERATOR_QUERIES: dict = {}
OPERATOR_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name, with SQL for the same result."""

    def register(function):
        OPERATOR_QUERIES[function.__name__] = function
        if sql is not None:
            OPERATOR_SQL[function.__name__] = sql.strip()
        return function

    return register


def _flat(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return flat_table(prepare(spark), folder, name)


def _utc(name: str):
    # the files hold times without zone; they are UTC
    return F.col(name).cast("timestamp")


# -- latest row per key ----------------------------------------------------------


@query("""
SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id) = 1
""")
def latest_version(spark, folder):
    events = _flat(spark, folder, "events").withColumn("ts", _utc("ts"))
    latest = latest_by(events, ["user_id"], [F.col("ts").desc()], [F.col("event_id").asc()])
    return present(latest.select("user_id", "event_id", "event_type", "value", "ts"))


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY lineitem.l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1
""")
def latest_by_two_keys(spark, folder):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = _flat(spark, folder, "lineitem").select(*columns, _utc("l_shipdate").alias("l_shipdate"))
    rest = [F.col(name).asc() for name in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")]
    return present(latest_by(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()], rest))


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def qualify_latest(spark, folder):
    orders = _flat(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    latest = latest_by(orders, ["o_custkey"], [F.col("o_orderdate").desc()], [F.col("o_orderkey").desc()])
    return latest.drop("o_orderdate")


# -- JSON --------------------------------------------------------------------------


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_scalar(spark, folder):
    parsed = parse_payload(_flat(spark, folder, "events"), "props", {"k_text": "k"}, ["event_id"])
    return parsed.withColumn("k", safe_long(F.col("k_text")))


@query(with_ctes((CUST_VERSION,), """
SELECT customer_id, version = 1 AS is_newest, tags, CASE WHEN has_address THEN city END AS city,
       CASE WHEN by_email THEN consent END AS consent_state FROM cust_version
"""))
def json_nested(spark, folder):
    raw = open_warehouse(spark, folder)["raw_customers"]
    paths = {"city": "default_address.city", "consent_state": "email_marketing_consent.state", "tags": "tags"}
    parsed = parse_payload(raw, "payload", paths, ["record_id", "extracted_at"])
    return parsed.select(
        safe_long(F.col("record_id")).alias("customer_id"),
        (utc_date(F.col("extracted_at")) == F.lit("2001-08-01").cast("date")).alias("is_newest"),
        *paths,
    )


@query(with_ctes((LINES,), """
SELECT order_id, l_orderkey * 100 + l_linenumber AS line_id, units AS quantity FROM item
"""))
def json_array_explode(spark, folder):
    raw = open_warehouse(spark, folder)["raw_orders"]
    lines = explode_json_array(raw.select("record_id", "payload"), "payload", "line_items", "line")
    parsed = parse_payload(lines, "line", {"line_id": "id", "quantity": "quantity"}, ["record_id"])
    return parsed.select(
        safe_long(F.col("record_id")).alias("order_id"),
        safe_long(F.col("line_id")).alias("line_id"),
        safe_long(F.col("quantity")).alias("quantity"),
    )


@query(with_ctes((LINES, ORD), """
SELECT order_id, true AS is_newest, price FROM ord
  JOIN (VALUES (1, '9.95'), (2, '12.50'), (2, 'free')) AS shipping_line(remainder, price)
    ON o_orderkey % 3 = remainder AND order_id = o_orderkey
UNION ALL SELECT order_id, true, NULL FROM ord WHERE o_orderkey % 3 = 0 OR order_id <> o_orderkey
UNION ALL SELECT order_id, false, NULL FROM ord WHERE o_orderkey % 5 = 0
"""))
def json_array_outer(spark, folder):
    raw = open_warehouse(spark, folder)["raw_orders"].select("record_id", "extracted_at", "payload")
    lines = explode_json_array(raw, "payload", "shipping_lines", "line", outer=True)
    parsed = parse_payload(lines, "line", {"price": "price"}, ["record_id", "extracted_at"])
    return parsed.select(
        safe_long(F.col("record_id")).alias("order_id"),
        (utc_date(F.col("extracted_at")) == F.lit("2001-08-01").cast("date")).alias("is_newest"),
        "price",
    )


@query(with_ctes((LINES, ORD), """
SELECT order_id, count(*) AS refund_lines, CAST(sum(units) AS BIGINT) AS refunded_units FROM (
  SELECT ord.order_id, units FROM item JOIN ord ON item.order_id = ord.order_id WHERE l_returnflag = 'R'
  UNION ALL SELECT order_id, 0 FROM ord WHERE o_orderkey % 50 IN (0, 10, 25) AND order_id = o_orderkey
) GROUP BY order_id
"""))
def nested_unnest(spark, folder):
    raw = open_warehouse(spark, folder)["raw_orders"].select("record_id", "payload")
    refunds = explode_json_array(raw, "payload", "refunds", "refund").drop("payload")
    lines = explode_json_array(refunds, "refund", "refund_line_items", "line", outer=True)
    parsed = parse_payload(lines, "line", {"quantity": "quantity"}, ["record_id"])
    return (
        parsed.groupBy(safe_long(F.col("record_id")).alias("order_id"))
        .agg(
            F.count(F.lit(1)).alias("refund_lines"),
            F.sum(F.coalesce(safe_long(F.col("quantity")), F.lit(0))).alias("refunded_units"),
        )
    )


@query(with_ctes((LINES, ORD), """
SELECT first_location, count(*) AS refunds FROM (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN (l_suppkey + 3) % 16 END AS first_location
  FROM item JOIN ord ON item.order_id = ord.order_id WHERE l_returnflag = 'R'
  UNION ALL SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_custkey % 14 END FROM ord
            WHERE o_orderkey % 50 IN (0, 10, 25) AND order_id = o_orderkey
) GROUP BY first_location
"""))
def json_first_element(spark, folder):
    raw = open_warehouse(spark, folder)["raw_orders"].select("payload")
    refunds = explode_json_array(raw, "payload", "refunds", "refund").select("refund")
    first = F.get(json_list(F.col("refund"), "transactions"), F.lit(0))
    parsed = parse_payload(refunds.withColumn("first", first), "first", {"place": "location_id"}, [])
    return parsed.groupBy(safe_long(F.col("place")).alias("first_location")).agg(
        F.count(F.lit(1)).alias("refunds")
    )


# -- casts and numbers ---------------------------------------------------------------


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS good_long, CAST(NULL AS BIGINT) AS bad_long,
       CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(value AS DECIMAL(28,2)) AS DOUBLE) END AS amount,
       '1234567890123456' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') || '.500000000' AS large_amount,
       CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen_at
FROM events
""")
def safe_casts(spark, folder):
    i = F.col("event_id")
    number = F.col("value").cast("decimal(28,2)").cast("string")
    return present(
        _flat(spark, folder, "events").select(
            "event_id",
            safe_long(F.get_json_object("props", "$.k")).alias("good_long"),
            safe_long(F.col("event_type")).alias("bad_long"),
            safe_money(F.when(i % 3 == 0, F.concat(number, F.lit(" dollars"))).otherwise(number)).alias("amount"),
            safe_money(
                F.concat(F.lit("1234567890123456"), F.lpad((i % 10000).cast("string"), 4, "0"), F.lit(".50"))
            ).cast("string").alias("large_amount"),
            safe_ts(
                F.when(i % 4 == 0, F.date_format(_utc("ts"), "yyyy")).otherwise(
                    F.date_format(_utc("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
                )
            ).alias("seen_at"),
        )
    )


@query("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM events
""")
def strict_bool(spark, folder):
    i = F.col("event_id") % 6
    text = (
        F.when(i == 0, "true").when(i == 1, "FALSE").when(i == 2, "yes").when(i == 3, "1").when(i == 4, "")
    )
    return _flat(spark, folder, "events").select("event_id", safe_bool(text).alias("flag"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_quantity / NULLIF(l_linenumber - 1, 0) AS ratio,
       100 / NULLIF(l_quantity / NULLIF(l_linenumber - 1, 0), 0) AS nested_ratio
FROM lineitem
""")
def safe_division(spark, folder):
    ratio = safe_divide(F.col("l_quantity"), F.col("l_linenumber") - 1)
    return present(
        _flat(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            ratio.alias("ratio"), safe_divide(F.lit(100), ratio).alias("nested_ratio"),
        )
    )


@query("""
SELECT s_suppkey, CAST(round(CAST(s_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
       CAST(abs(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS size,
       CAST(-CAST(s_acctbal AS DECIMAL(18,2)) * 3 + 1 AS DOUBLE) AS mirrored,
       least(s_acctbal, 1000.0) AS capped
FROM supplier
""")
def round_half(spark, folder):
    balance = F.col("s_acctbal").cast("decimal(18,2)")
    return _flat(spark, folder, "supplier").select(
        "s_suppkey",
        F.round(balance, 1).cast("double").alias("rounded"),
        F.abs(balance).cast("double").alias("size"),
        (-balance * 3 + 1).cast("double").alias("mirrored"),
        F.least(F.col("s_acctbal"), F.lit(1000.0)).alias("capped"),
    )


# -- text ------------------------------------------------------------------------------


@query("""
SELECT c_custkey, lower(c_name) AS low, upper(c_mktsegment) AS high,
       CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_mktsegment || ' ' || c_nationkey END AS trimmed,
       CASE WHEN c_custkey % 3 <> 0 THEN c_name || '-' || c_nationkey END AS joined,
       string_split(c_name, '#')[1] AS first_part
FROM customer
""")
def string_ops(spark, folder):
    some = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string"))
    padded = F.concat(F.lit("\t "), F.col("c_mktsegment"), F.lit(" "), F.coalesce(some, F.lit(" \n")))
    return _flat(spark, folder, "customer").select(
        "c_custkey",
        F.lower("c_name").alias("low"),
        F.upper("c_mktsegment").alias("high"),
        trim_blanks(padded).alias("trimmed"),
        F.concat("c_name", F.lit("-"), some).alias("joined"),
        F.get(F.split("c_name", "#"), F.lit(0)).alias("first_part"),
    )


@query(with_ctes((PROD,), """
SELECT product_id, product_id % 2 = 0 AS in_season, product_id % 11 = 0 AS in_classics FROM prod
"""))
def tag_exists(spark, folder):
    products = open_warehouse(spark, folder)["products"]
    return products.select(
        "product_id",
        has_tag(F.col("tags"), "season_aw26").alias("in_season"),
        has_tag(F.col("tags"), "CLASSICS").alias("in_classics"),
    )


@query(r"""
SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '#1\d') THEN regexp_extract(p_brand, '#(1\d)', 1) END AS teen_brand
FROM part
""")
def regex_extract(spark, folder):
    return _flat(spark, folder, "part").select(
        "p_partkey", extract_first(F.col("p_brand"), r"#(1\d)").alias("teen_brand")
    )


@query(r"""
SELECT p_partkey, regexp_matches(lower(p_name), '\brings?\b') AS is_ring,
       regexp_matches(lower(p_name), '(^|\s)(old|new)\s') AS has_age FROM part
""")
def regex_flags(spark, folder):
    return _flat(spark, folder, "part").select(
        "p_partkey",
        matches(F.col("p_name"), r"\brings?\b").alias("is_ring"),
        matches(F.col("p_name"), r"(^|\s)(old|new)\s").alias("has_age"),
    )


@query("""
SELECT p_partkey, p_type FROM part WHERE upper(COALESCE(p_type, '')) LIKE '%ROMO%'
""")
def like_filter(spark, folder):
    parts = _flat(spark, folder, "part")
    return parts.where(F.upper(F.coalesce("p_type", F.lit(""))).contains("ROMO")).select("p_partkey", "p_type")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS line_count, CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND NOT (l_linestatus = 'F' AND l_linenumber NOT IN (1, 2))
  AND (l_discount > 0 OR NULLIF(l_tax, 0) IS NULL)
GROUP BY l_returnflag, l_linestatus
""")
def boolean_algebra(spark, folder):
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    kept = _flat(spark, folder, "lineitem").where(
        F.col("l_returnflag").isin("A", "R")
        & ~((F.col("l_linestatus") == "F") & ~F.col("l_linenumber").isin(1, 2))
        & ((F.col("l_discount") > 0) | tax.isNull())
    )
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").cast("bigint").alias("units")
    )


# -- time ------------------------------------------------------------------------------


@query(f"""
SELECT event_id, {melbourne_date('ts')} AS trading_date, CAST(CAST(ts AS DATE) AS VARCHAR) AS utc_date FROM events
""")
def local_trading_date(spark, folder):
    ts = _utc("ts")
    return present(
        _flat(spark, folder, "events").select(
            "event_id",
            local_date(ts, "Australia/Melbourne").alias("trading_date"),
            utc_date(ts).alias("utc_date"),
        )
    )


@query("""
SELECT o_custkey, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-02') AS days FROM orders
GROUP BY o_custkey
""")
def days_since(spark, folder):
    today = utc_date(instant(datetime(2001, 8, 2)))
    latest = _flat(spark, folder, "orders").groupBy("o_custkey").agg(F.max(_utc("o_orderdate")).alias("latest"))
    return latest.select("o_custkey", days_between(today, utc_date(F.col("latest"))).alias("days"))


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAY
""")
def relative_window(spark, folder):
    since = days_before(datetime(2001, 8, 1), 30).cast("timestamp_ntz")
    return _flat(spark, folder, "orders").where(F.col("o_orderdate") >= since).select("o_orderkey", "o_custkey")


# -- aggregations ------------------------------------------------------------------------


@query("""
SELECT user_id, event_type,
       CAST(sum(CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN event_id % 10 ELSE 0 END) AS BIGINT) AS units_7,
       CAST(sum(CASE WHEN ts >= TIMESTAMP '2024-01-17' THEN event_id % 10 ELSE 0 END) AS BIGINT) AS units_14,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at
FROM events GROUP BY user_id, event_type
""")
def conditional_units(spark, folder):
    events = _flat(spark, folder, "events").select(
        "user_id", "event_type", _utc("ts").alias("ts"), (F.col("event_id") % 10).alias("units")
    )
    keys = ["user_id", "event_type"]
    return present(
        windowed_units(events, keys, "ts", "units", datetime(2024, 1, 31), {"units_7": 7, "units_14": 14})
    )


_EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


@query("SELECT user_id, " + ", ".join(
    f"max(value) FILTER (event_type = '{kind}') AS {kind}_most, max(event_id) FILTER (event_type = '{kind}') AS {kind}_last"
    for kind in _EVENT_TYPES
) + " FROM events GROUP BY user_id")
def pivot_fixed_names(spark, folder):
    events = _flat(spark, folder, "events").select("user_id", "event_type", "value", "event_id")
    names = tuple((kind, kind) for kind in _EVENT_TYPES)
    return pivot_fixed(events, "user_id", "event_type", names, {"most": "value", "last": "event_id"})


@query("""
SELECT l_suppkey, count(DISTINCT l_orderkey) AS order_count, count(DISTINCT l_partkey) AS part_count,
       count(*) AS line_count, min(l_quantity) AS least, max(l_quantity) AS most,
       strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_shipped
FROM lineitem GROUP BY l_suppkey
""")
def distinct_counts(spark, folder):
    return present(
        _flat(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count_distinct("l_orderkey").alias("order_count"),
            F.count_distinct("l_partkey").alias("part_count"),
            F.count(F.lit(1)).alias("line_count"),
            F.min("l_quantity").alias("least"),
            F.max("l_quantity").alias("most"),
            F.min(_utc("l_shipdate")).alias("first_shipped"),
        )
    )


@query("""
SELECT day, CAST(CAST(sum(ordered) AS DECIMAL(28,2)) AS DOUBLE) AS ordered,
       CAST(CAST(sum(returned) AS DECIMAL(28,2)) AS DOUBLE) AS returned,
       CAST(sum(order_count) AS BIGINT) AS order_count
FROM (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS ordered,
         0 AS returned, 1 AS order_count FROM orders
  UNION ALL
  SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 0, CAST(l_extendedprice AS DECIMAL(18,2)), 0
  FROM lineitem WHERE l_returnflag = 'R'
) GROUP BY day
""")
def union_reaggregate(spark, folder):
    money = "decimal(18,2)"
    zero = F.lit(0).cast(money)
    # each stream is grouped on its own before the union
    ordered = (
        _flat(spark, folder, "orders")
        .groupBy(utc_date(_utc("o_orderdate")).alias("day"))
        .agg(F.sum(F.col("o_totalprice").cast(money)).alias("ordered"), F.count(F.lit(1)).alias("order_count"))
        .withColumn("returned", zero)
    )
    returned = (
        _flat(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy(utc_date(_utc("l_shipdate")).alias("day"))
        .agg(F.sum(F.col("l_extendedprice").cast(money)).alias("returned"))
        .withColumns({"ordered": zero, "order_count": F.lit(0).cast("bigint")})
    )
    return present(
        ordered.unionByName(returned)
        .groupBy("day")
        .agg(*[F.sum(name).alias(name) for name in ("ordered", "returned", "order_count")])
    )


# -- joins ---------------------------------------------------------------------------------


@query("""
SELECT n_name, r_name, count(*) AS line_count, CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_name, r_name
""")
def inner_star(spark, folder):
    lines = _flat(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("units")
    )
    orders = _flat(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = _flat(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = _flat(spark, folder, "nation").join(
        _flat(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "r_name")
        .agg(F.sum("line_count").alias("line_count"), F.sum("units").cast("bigint").alias("units"))
    )


@query("""
SELECT c_custkey, count(o_orderkey) AS order_count,
       CAST(COALESCE(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS spent
FROM customer LEFT JOIN orders
  ON lower(CASE WHEN c_custkey % 5 > 0 THEN 'User-' || c_custkey END) = lower('uSER-' || o_custkey)
GROUP BY c_custkey
""")
def left_expr_join(spark, folder):
    name = F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit("User-"), F.col("c_custkey").cast("string")))
    orders = (
        _flat(spark, folder, "orders")
        .groupBy(F.lower(F.concat(F.lit("uSER-"), F.col("o_custkey").cast("string"))).alias("buyer"))
        .agg(F.count("o_orderkey").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )
    # a NULL key becomes one of its own that no buyer has: NULLs would share a task
    key = F.coalesce(F.lower(name), F.concat(F.lit("\u0000"), F.col("c_custkey").cast("string")))
    return (
        _flat(spark, folder, "customer")
        .select("c_custkey", key.alias("key"))
        .join(orders, F.col("key") == F.col("buyer"), "left")
        .select(
            "c_custkey",
            F.coalesce("n", F.lit(0)).alias("order_count"),
            F.coalesce("total", F.lit(0)).cast("double").alias("spent"),
        )
    )


@query("""
SELECT p.l_partkey, p.l_suppkey, p.line_count, COALESCE(r.return_count, 0) AS return_count
FROM (SELECT l_partkey, l_suppkey, count(*) AS line_count FROM lineitem GROUP BY ALL) AS p
LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS return_count FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) AS r
  ON p.l_partkey = r.l_partkey AND p.l_suppkey = r.l_suppkey
""")
def left_two_keys(spark, folder):
    keys = ["l_partkey", "l_suppkey"]
    lines = _flat(spark, folder, "lineitem").select(*keys, "l_returnflag")
    sold = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("line_count"))
    returned = (
        lines.where(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count(F.lit(1)).alias("return_count"))
    )
    return sold.join(returned, keys, "left").select(
        *keys, "line_count", F.coalesce("return_count", F.lit(0)).alias("return_count")
    )


@query(with_ctes(CANDIDATE_CHAIN, """
SELECT send_from_location_name, send_to_location_name, count(*) AS move_count,
       count(*) FILTER (candidate_rank = 1) AS best_donor_count,
       count(*) FILTER (donor_rank = 1) AS best_receiver_count
FROM candidate GROUP BY send_from_location_name, send_to_location_name
"""))
def rotation_lanes(spark, folder):
    """The self-join on variant and two rankings, summed up per lane."""
    candidates = open_warehouse(spark, folder).model("store_rotation_candidates")
    return candidates.groupBy("send_from_location_name", "send_to_location_name").agg(
        F.count(F.lit(1)).alias("move_count"),
        F.count_if(F.col("candidate_rank") == 1).alias("best_donor_count"),
        F.count_if(F.col("donor_rank") == 1).alias("best_receiver_count"),
    )


# -- ranks ------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank
FROM orders
""")
def whole_table_rank(spark, folder):
    orders = _flat(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], "price_rank")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
FROM lineitem AS l
JOIN (SELECT l_orderkey AS k, max(l_quantity) AS most FROM lineitem GROUP BY l_orderkey) ON l_orderkey = k
WHERE l_quantity = most
QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 1
""")
def single_best_line(spark, folder):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    lines = _flat(spark, folder, "lineitem").select(*columns)
    rest = [F.col(name).asc() for name in ("l_linenumber", "l_partkey", "l_suppkey")]
    return present(unique_winner(lines, ["l_orderkey"], "l_quantity", rest))
