"""Commerce documents derived from flat sales tables.

The models read JSON envelopes. Where only flat tables are at hand (``part``,
``nation``, ``region``, ``customer``, ``orders``, ``lineitem``) this module states
them as the documents a shop would send, with the irregularities real documents
have: older versions, missing and wrongly typed values, empty arrays, refunds.
Only integer and decimal arithmetic is used, so that plain SQL over the flat
tables can state the same results.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.config import INTERNAL_LOCATIONS, SALES_LOCATION_NAMES, RetailConfig
from stockflow.operators.rank import global_rank
from stockflow.session import scratch_path
from stockflow.sources.envelope import normalise_phones, to_envelope

SOURCE = "shop"
AS_OF = datetime(2001, 8, 2)
EXTRACTED_AT = "2001-08-01 06:00:00"
EXTRACTED_BEFORE = "2001-07-31 06:00:00"

# location id = nation key; the first of the list is number 0
LOCATION_NAMES = (
    "Online / Warehouse",
    "Flinders Lane",
    "Fitzroy",
    "Newtown",
    "Smith St",
    "Melbourne Outlet",
    "Claremont",
    "Paddington",
    "Oxford St",
    "Wellington",
    "James St",
    "Spring1883",
    *INTERNAL_LOCATIONS,
)
SALES_NAMES = tuple(sales for sales, _ in SALES_LOCATION_NAMES)

# A document holds each line number of an order once; lines that share one are put on
# further documents, whose ids are this far apart.
REPEAT_ID_STEP = 1_000_000_000_000
# rows that one task turns into documents
ROWS_PER_TASK = 200_000
# an order with more lines is spread over tasks
CROWDED = 100_000
# tells all lines of an order apart that differ at all
LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

FEED_CONFIG = RetailConfig(as_of=AS_OF, sock_pattern=r"\brings?\b")


def flat_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _col(name: str) -> Column:
    return F.col(name)


def _tasks(*tables: DataFrame) -> int:
    """Partitions for rows that become much wider documents: they follow from the count."""
    least = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, sum(rows.count() for rows in tables) // ROWS_PER_TASK)


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose documents are much wider than they are, in a number of partitions that
    follows from their count and is not reduced to fit their size."""
    return rows.repartition(_tasks(rows), key)


def _text(*parts) -> Column:
    return F.concat(*[part.cast("string") if isinstance(part, Column) else F.lit(part) for part in parts])


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _pick(names: tuple[str, ...], index: Column) -> Column:
    """Element of a fixed list, NULL beyond its end."""
    return F.get(F.array(*[F.lit(name) for name in names]), index.cast("int"))


def _versions(condition: Column) -> Column:
    """Version 1 always, and an older version 0 where the condition holds."""
    return F.explode(F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))


def _extracted(version: Column) -> Column:
    return (
        F.when(version == 0, F.lit(EXTRACTED_BEFORE)).otherwise(F.lit(EXTRACTED_AT)).cast("timestamp")
    )


def _raw(documents: DataFrame, entity: str, id_paths=("id",)) -> DataFrame:
    """Documents with columns ``item`` and ``version`` as raw rows."""
    # the filter on the id would be moved below what makes the documents, and make each one twice:
    # it stays above a generator, and phones come last
    made = documents.select(F.explode(F.array("item")).alias("item"), "version")
    raw = to_envelope(made, SOURCE, entity, id_paths, _extracted(F.col("version")))
    return raw.withColumn("payload", normalise_phones(_col("payload"), entity))


def _price(amount: Column) -> Column:
    return amount.cast("decimal(18,2)").cast("string")


# -- locations ---------------------------------------------------------------


def location_documents(spark: SparkSession, folder: str) -> DataFrame:
    nation = flat_table(spark, folder, "nation")
    region = flat_table(spark, folder, "region")
    key = F.col("n_nationkey").cast("bigint")
    is_store = key < len(LOCATION_NAMES)
    item = F.to_json(
        F.struct(
            key.alias("id"),
            F.coalesce(_pick(LOCATION_NAMES, key), _col("n_name")).alias("name"),
            (key + 61_390_000_000).alias("phone"),
            _text(key, " High Street").alias("address1"),
            F.when(key % 3 == 0, _text("Level ", key)).alias("address2"),
            _col("n_name").alias("city"),
            _col("r_name").alias("province"),
            F.substring("r_name", 1, 2).alias("province_code"),
            _col("n_name").alias("country"),
            F.substring("n_name", 1, 2).alias("country_code"),
            F.lpad(key.cast("string"), 4, "0").alias("zip"),
            # 'yes' is no JSON boolean: the safe cast must give NULL
            F.when(key == 24, F.lit("yes")).otherwise(is_store.cast("string")).alias("active"),
            (key % 5 == 0).alias("legacy"),
            F.lit("1995-01-01T00:00:00Z").alias("created_at"),
            F.lit("1995-06-01T10:00:00+10:00").alias("updated_at"),
        )
    )
    return nation.join(region, _col("n_regionkey") == _col("r_regionkey")).select(
        item.alias("item"), F.lit(1).alias("version")
    )


# -- products, variants and stock ---------------------------------------------


def product_documents(spark: SparkSession, folder: str) -> DataFrame:
    part = _spread(flat_table(spark, folder, "part"), "p_partkey").withColumn(
        "version", _versions(_col("p_partkey") % 4 == 0)
    )
    key = _col("p_partkey")
    price = _col("p_retailprice").cast("decimal(18,2)")
    tags = F.concat_ws(
        ",",
        F.lit("all"),
        F.when(key % 2 == 0, F.lit(" Season_AW26")),
        F.when(key % 11 == 0, F.lit(" classics")),
        F.when(key % 13 == 0, F.lit(" aw26 rotation hold")),
        F.lit(" end"),
    )

    def variant(n: int) -> Column:
        variant_id = key * 10 + n
        return F.struct(
            variant_id.alias("id"),
            F.when(variant_id % 37 != 0, _text("SKU-", variant_id)).alias("sku"),
            F.lit(f"Size {n}").alias("title"),
            F.when(key % 3 == 0, _text("93", F.lpad(variant_id.cast("string"), 11, "0"))).alias("barcode"),
            _price(price + n).alias("price"),
            # not a number for every seventh product: the safe cast must give NULL
            F.when(key % 7 == 0, F.lit("n/a")).otherwise(_price(price + 10)).alias("compare_at_price"),
            (key % 50 + n).alias("inventory_quantity"),
            (variant_id + 1_000_000).alias("inventory_item_id"),
            F.lit("deny").alias("inventory_policy"),
            F.lit(SOURCE).alias("inventory_management"),
            F.lit("1995-01-01T00:00:00Z").alias("created_at"),
            F.lit("1996-01-01T00:00:00Z").alias("updated_at"),
        )

    newest = _col("version") == 1
    # the older version and every 101st product have an empty list of variants
    count = F.when(newest & (key % 101 != 100), F.lit(2)).otherwise(F.lit(0))
    variants = F.slice(F.array(variant(0), variant(1)), F.lit(1), count)
    item = F.to_json(
        F.struct(
            key.alias("id"),
            F.when(newest, _col("p_name")).otherwise(F.lit("draft")).alias("title"),
            F.regexp_replace("p_name", " ", "-").alias("handle"),
            _col("p_brand").alias("vendor"),
            F.when(_col("p_type") == "PROMO", F.lit("Denim")).otherwise(_col("p_type")).alias("product_type"),
            F.when(_col("p_size") > 5, F.lit("active")).otherwise(F.lit("draft")).alias("status"),
            tags.alias("tags"),
            F.lit("1995-01-01T00:00:00Z").alias("created_at"),
            F.when(newest, F.lit("1997-03-01T00:00:00Z")).otherwise(F.lit("1997-02-01T00:00:00Z")).alias("updated_at"),
            F.when(_col("p_size") > 5, F.lit("1997-01-01T00:00:00+11:00")).otherwise(F.lit("")).alias("published_at"),
            variants.alias("variants"),
        )
    )
    return part.select(item.alias("item"), "version")


def inventory_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Two variants of every product at every named location."""
    p, v, at = _col("p_partkey"), _col("v"), _col("at")
    levels = (
        flat_table(spark, folder, "part")
        .select("p_partkey")
        # every row becomes some thirty documents: spread the keys before, not after,
        # in a number of partitions that is not reduced to fit the size of the keys
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
        .select("p_partkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(len(LOCATION_NAMES) - 1))).alias("at"))
        .withColumn("version", _versions((p % 10 == 0) & (at % 3 == 0)))
    )
    store = F.expr("(p_partkey * (at + 3) + v * (2 + at % 3) + (p_partkey div 6) * at + at) % 5 - 1")
    warehouse = F.expr("(p_partkey * 5 + v * 2 + p_partkey div 7) % 4 - 2")
    newest = _col("version") == 1
    available = F.when(~newest, F.lit(99)).when(at == 0, warehouse).otherwise(store)
    item = F.to_json(
        F.struct(
            (p * 10 + v + 1_000_000).alias("inventory_item_id"),
            # a location nobody knows: such levels have no match
            F.when((at == 13) & (p % 53 == 0), F.lit(77)).otherwise(at).alias("location_id"),
            F.when(~((p % 29 == 0) & (at == 5) & newest), available).alias("available"),
            F.when(newest, F.lit("2001-07-31T00:00:00Z")).otherwise(F.lit("2001-07-01T00:00:00Z")).alias("updated_at"),
        )
    )
    return levels.select(item.alias("item"), "version")


# -- customers -----------------------------------------------------------------


def customer_documents(spark: SparkSession, folder: str) -> DataFrame:
    key = _col("c_custkey")
    customers = _spread(flat_table(spark, folder, "customer"), "c_custkey").withColumn(
        "version", _versions(key % 10 == 0)
    )
    newest = _col("version") == 1
    # customer 49 of every fifty uses the address of customer 48, in capitals
    email = (
        F.when(key % 17 == 0, F.lit(None).cast("string"))
        .when(key % 50 == 49, _text("CUST", key - 1, "@EXAMPLE.COM"))
        .otherwise(_text("Cust", key, "@Example.com"))
    )
    consent = F.struct(
        F.when(key % 2 == 0, F.lit("subscribed")).otherwise(F.lit("not_subscribed")).alias("state"),
        F.lit("single_opt_in").alias("opt_in_level"),
        F.when(key % 4 == 0, F.lit("2000-05-05T05:05:05Z")).otherwise(F.lit("never")).alias("consent_updated_at"),
    )
    address = F.struct(
        _text("Country ", _col("c_nationkey")).alias("country"),
        _text("C", _col("c_nationkey")).alias("country_code"),
        _col("c_mktsegment").alias("province"),
        F.substring("c_mktsegment", 1, 3).alias("province_code"),
        _text("City ", key % 100).alias("city"),
        F.lpad((key % 10000).cast("string"), 4, "0").alias("zip"),
        # no such key for every sixteenth customer
        F.when(key % 16 != 1, key + 61_400_000_000).alias("phone"),
    )
    item = F.to_json(
        F.struct(
            key.alias("id"),
            email.alias("email"),
            _col("c_name").alias("first_name"),
            F.when(key % 3 == 0, F.lit(" ")).when(key % 3 == 1, _text("Family", key % 100, "\u00a0")).alias("last_name"),
            F.when(key % 2 == 0, key + 61_400_000_000).alias("phone"),
            F.when(newest, F.lit("enabled")).otherwise(F.lit("invited")).alias("state"),
            F.lit("AUD").alias("currency"),
            (key % 20).alias("orders_count"),
            _price(_col("c_acctbal")).alias("total_spent"),
            F.when(key % 6 == 0, F.lit("yes")).otherwise((key % 2 == 0).cast("string")).alias("verified_email"),
            (key % 9 == 0).alias("tax_exempt"),
            F.when(key % 5 != 0, consent).alias("email_marketing_consent"),
            F.when(key % 5 == 0, consent).alias("sms_marketing_consent"),
            F.lit("1995-01-01T00:00:00Z").alias("created_at"),
            F.when(newest, F.lit("2001-07-15T00:00:00Z")).otherwise(F.lit("2001-06-15T00:00:00Z")).alias("updated_at"),
            (key * 7).alias("last_order_id"),
            _text("#", key * 7).alias("last_order_name"),
            F.when(key % 8 != 0, address).alias("default_address"),
        )
    )
    # tags: mostly text, for every 23rd customer an array, which is no scalar
    tags = F.when(key % 23 == 0, F.lit('["a","b"]')).otherwise(_text('"vip', key % 3, '"'))
    with_tags = F.concat(F.lit('{"tags":'), tags, F.lit(","), F.substr(item, F.lit(2)))
    return customers.select(with_tags.alias("item"), "version")


# -- orders --------------------------------------------------------------------


def _crowded_orders(lines: DataFrame) -> DataFrame:
    """Keys of the orders with more than ``CROWDED`` lines, written to the shared folder: at
    most one for so many lines."""
    path = scratch_path(lines.sparkSession, "crowded")
    counted = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    counted.where(_col("lines") > CROWDED).select(_col("l_orderkey").alias("crowded")).write.parquet(path)
    return lines.sparkSession.read.parquet(path)


def _numbered_by_order(lines: DataFrame) -> DataFrame:
    """Lines numbered where all lines of an order are together: one shuffle of narrow rows,
    which the documents of an order and the join with it go on using."""
    pair = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*[_col(name).asc() for name in LINE_ORDER[2:]])
    return _spread(lines, "l_orderkey").withColumn(
        "order_id", _col("l_orderkey") + (F.row_number().over(pair) - 1) * REPEAT_ID_STEP
    )


def _numbered_by_position(lines: DataFrame) -> DataFrame:
    """Lines numbered by their position in the whole table, so that a pair with very many
    lines is not gathered anywhere."""
    ranked = global_rank(lines, [_col(name).asc() for name in LINE_ORDER], "position")
    first = ranked.groupBy(_col("l_orderkey").alias("of_order"), _col("l_linenumber").alias("of_number")).agg(
        F.min("position").alias("first")
    )
    same = (_col("l_orderkey") == _col("of_order")) & _col("l_linenumber").eqNullSafe(_col("of_number"))
    return ranked.join(first, same).select(
        *lines.columns, (_col("l_orderkey") + (_col("position") - _col("first")) * REPEAT_ID_STEP).alias("order_id")
    )


def _numbered_parts(spark: SparkSession, folder: str) -> list[tuple[DataFrame, DataFrame]]:
    """Orders and their numbered lines: those of ordinary size, and the crowded ones if any."""
    orders, lines = (flat_table(spark, folder, name) for name in ("orders", "lineitem"))
    crowded = _crowded_orders(lines)
    if crowded.isEmpty():
        return [(orders, _numbered_by_order(lines))]

    def some(rows: DataFrame, key: str, how: str) -> DataFrame:
        return rows.join(F.broadcast(crowded), _col(key) == _col("crowded"), how)

    few, many = (
        (some(orders, "o_orderkey", how), some(lines, "l_orderkey", how)) for how in ("left_anti", "left_semi")
    )
    return [(few[0], _numbered_by_order(few[1])), (many[0], _numbered_by_position(many[1]))]


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with ``order_id`` of their document.

    Lines with the same order and line number are counted from 0 in a total order, and
    line n goes to document n of its order. So a document holds as many lines as there
    are line numbers at most, and no line is left out.
    """
    return reduce(DataFrame.unionByName, [lines for _, lines in _numbered_parts(spark, folder)])


def _line_columns(lines: DataFrame, *keys: str) -> DataFrame:
    """The keys, amounts of a line item, its JSON document and the refund of a returned one."""
    number, part, supplier = _col("l_linenumber"), _col("l_partkey"), _col("l_suppkey")
    with_amounts = lines.select(
        "*",
        _col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        _col("l_quantity").cast("bigint").alias("units"),
        F.when(part % 19 != 0, F.when(number % 2 == 1, part % 200).otherwise(part)).alias("product"),
    ).select(
        "*",
        F.round(_col("price") * _col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("discount"),
        F.round(_col("price") * _col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("tax"),
        (_col("price") * _col("units").cast("decimal(10,0)")).cast("decimal(28,2)").alias("gross"),
        (_col("product") * 10 + supplier % 2).alias("variant"),
    )
    sku = (
        F.when(_col("product").isNotNull(), _text("SKU-", _col("variant")))
        .when(supplier % 2 == 0, F.lit(""))
        .otherwise(_text("PART-", part))
    )
    line = F.struct(
        (_col("l_orderkey") * 100 + number).alias("id"),
        _col("product").alias("product_id"),
        _col("variant").alias("variant_id"),
        sku.alias("sku"),
        _text("Style ", part % 200).alias("name"),
        _text("Size ", supplier % 2).alias("variant_title"),
        _text("Supplier ", supplier % 10).alias("vendor"),
        _col("units").alias("quantity"),
        _price(_col("price")).alias("price"),
        _price(_col("discount")).alias("total_discount"),
    )
    even = number % 2 == 0
    refund = F.struct(
        _iso(_col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=number * 3)).alias("processed_at"),
        F.array(
            F.struct(
                F.when(even, supplier % 16).alias("location_id"),
                _price(_col("gross") - _col("discount")).alias("subtotal"),
                _price(_col("tax")).alias("total_tax"),
                _col("units").alias("quantity"),
            )
        ).alias("refund_line_items"),
        F.when(~even, F.array(F.struct(((supplier + 3) % 16).alias("location_id")))).alias("transactions"),
    )
    return with_amounts.select(
        *keys,
        "l_orderkey",
        "gross",
        "discount",
        "tax",
        F.when(_col("l_orderkey").isNotNull(), line).alias("line"),
        F.when(_col("l_returnflag") == "R", refund).alias("refund"),
    )


def _line_groups(lines: DataFrame, *keys: str) -> DataFrame:
    """What a document says about its lines; rows without a line give a document without any."""
    some = F.count("l_orderkey") > 0
    return _line_columns(lines, *[key for key in keys if key != "l_orderkey"]).groupBy(*keys).agg(
        F.sum(_col("gross") - _col("discount")).alias("subtotal"),
        F.sum("discount").alias("discounts"),
        F.sum("tax").alias("taxes"),
        F.when(some, F.sort_array(F.collect_list("line"))).alias("lines"),
        F.when(some, F.sort_array(F.collect_list("refund"))).alias("line_refunds"),
    )


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [_order_documents(*part) for part in _numbered_parts(spark, folder)])


def _order_documents(orders: DataFrame, numbered: DataFrame) -> DataFrame:
    key = _col("o_orderkey")
    with_lines = orders.join(_line_groups(numbered, "l_orderkey", "order_id"), key == _col("l_orderkey"), "left")
    return _order_items(with_lines.withColumn("version", _versions(key % 5 == 0)), "version")


def _order_items(orders: DataFrame, *keep: str) -> DataFrame:
    """The document of every version of an order, beside the columns to keep."""
    key, customer = _col("o_orderkey"), _col("o_custkey")
    created = _col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(key % 24).cast("int"))
    orders = orders.withColumn("created", created)
    newest = _col("version") == 1
    # shipping, and refunds without lines, are on the first document of an order only
    first = F.coalesce(_col("order_id"), key) == key
    place = F.when(customer % 97 == 5, F.lit("Popup")).otherwise(_pick(SALES_NAMES, customer % 12))
    tags = F.when(customer % 13 == 0, F.lit("web")).otherwise(_text("vip, Location ", place, ", web"))
    email = F.when(customer % 17 != 0, F.when(key % 2 == 0, _text("cust", customer, "@example.com")).otherwise(
        _text("CUST", customer, "@Example.com")
    ))

    def amount(column: Column) -> Column:
        return F.when(newest, F.coalesce(column, F.lit(0)).cast("decimal(28,2)").cast("string")).otherwise(F.lit("0.00"))

    shipping_price = "struct<price:string,discounted_price:string>"
    shipping = F.when(key % 3 == 1, F.array(F.struct(F.lit("9.95").alias("price"), F.lit(None).cast("string").alias("discounted_price")))).when(
        key % 3 == 2,
        F.array(
            F.struct(F.lit("12.50").alias("price"), F.lit("10.00").alias("discounted_price")),
            F.struct(F.lit("free").alias("price"), F.lit(None).cast("string").alias("discounted_price")),
        ),
    ).cast(f"array<{shipping_price}>")
    # refunds without lines: with a transaction, without any, and with a bad date
    bare_time = F.when(key % 50 == 10, F.lit("pending")).otherwise(_iso(_col("created")))
    bare_refund = F.struct(
        bare_time.alias("processed_at"),
        F.lit(None).cast("array<struct<location_id:bigint,subtotal:string,total_tax:string,quantity:bigint>>").alias("refund_line_items"),
        F.when(key % 50 == 0, F.array(F.struct((customer % 14).alias("location_id")))).alias("transactions"),
    )
    refunds = F.when(
        (key % 50).isin(0, 10, 25) & first, F.concat(F.coalesce("line_refunds", F.array()), F.array(bare_refund))
    ).otherwise(_col("line_refunds"))
    document = F.to_json(
        F.struct(
            F.coalesce(_col("order_id"), key).alias("id"),
            _text("#", key).alias("name"),
            email.alias("email"),
            F.when(newest, F.lit("paid")).otherwise(F.lit("pending")).alias("financial_status"),
            F.when(_col("o_orderstatus") == "F", F.lit("fulfilled")).alias("fulfillment_status"),
            amount(_col("subtotal") + _col("taxes")).alias("total_price"),
            amount(_col("subtotal")).alias("subtotal_price"),
            amount(_col("taxes")).alias("total_tax"),
            amount(_col("discounts")).alias("total_discounts"),
            F.lit("AUD").alias("currency"),
            tags.alias("tags"),
            F.when(key % 3 == 0, key + 61_700_000_000).alias("phone"),
            F.struct((customer + 61_800_000_000).alias("phone")).alias("billing_address"),
            # every second order states its time in another zone
            F.when(key % 2 == 0, _iso(_col("created")))
            .otherwise(_text(F.date_format(_col("created") + F.expr("interval 10 hours"), "yyyy-MM-dd'T'HH:mm:ss"), "+10:00"))
            .alias("created_at"),
            # an order changes when it is made, and again after all orders were made
            _iso(
                F.when(newest, F.lit(AS_OF).cast("timestamp") + F.make_dt_interval(days=(key % 5).cast("int"))).otherwise(
                    _col("created")
                )
            ).alias("updated_at"),
            F.when((_col("o_orderstatus") == "F") & (key % 7 == 0), _iso(_col("created") + F.expr("interval 1 day"))).alias("cancelled_at"),
            F.when(newest, F.coalesce(_col("lines"), F.array())).alias("line_items"),
            F.when(newest & first, shipping).alias("shipping_lines"),
            F.when(newest, refunds).alias("refunds"),
        )
    )
    return orders.select(document.alias("item"), *keep)


# -- raw tables ------------------------------------------------------------------


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(product_documents(spark, folder), "product")


def raw_locations(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(location_documents(spark, folder), "location")


def raw_inventory_levels(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(inventory_documents(spark, folder), "inventory_level", ("inventory_item_id", "location_id"))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(customer_documents(spark, folder), "customer")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(order_documents(spark, folder), "order")


RAW_TABLES = {
    "raw_products": raw_products,
    "raw_locations": raw_locations,
    "raw_inventory_levels": raw_inventory_levels,
    "raw_customers": raw_customers,
    "raw_orders": raw_orders,
}


# -- landed pages ------------------------------------------------------------------

# entity -> (documents, array field of its pages)
PAGED_DOCUMENTS = {
    "product": (product_documents, "products"),
    "location": (location_documents, "locations"),
    "order": (order_documents, "orders"),
    "customer": (customer_documents, "customers"),
    "inventory_level": (inventory_documents, "inventory_levels"),
}


def delivered(documents: DataFrame, newest: bool) -> DataFrame:
    """The older versions, which came first, or the newest ones."""
    return documents.where(_col("version") == (1 if newest else 0))


def landed_pages(documents: DataFrame, field: str, page_size: int) -> DataFrame:
    """Documents in order of their id, ``page_size`` to a page, as response bodies.

    Pages are cut by position, so none is larger, whatever the ids look like.
    """
    numbered = documents.withColumn("id", F.get_json_object("item", "$.id").try_cast("bigint"))
    order = [_col(name).asc() for name in ("id", "version", "item")]
    ranked = global_rank(numbered, order, "position")
    return _bodies(ranked.withColumn("page_no", _page_no(page_size)), field)


def _page_no(page_size: int) -> Column:
    return F.floor((_col("position") - 1) / page_size) + 1


def _bodies(documents: DataFrame, field: str) -> DataFrame:
    pages = documents.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("position", "item"))).alias("entries"))
    items = F.concat_ws(",", F.transform("entries", lambda entry: entry["item"]))
    body = F.concat(F.lit(f'{{"{field}":['), items, F.lit("]}"))
    return pages.select("page_no", body.alias("body"))


# what a document says of its order
_HEAD = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "order_id")


def _order_heads(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of an order, without its lines: as many as its most frequent line
    number has lines, and at least one."""
    lines = flat_table(spark, folder, "lineitem")
    counted = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("lines"))
    needed = counted.groupBy("l_orderkey").agg(F.max("lines").alias("documents"))
    no = F.explode(F.sequence(F.lit(0), F.coalesce("documents", F.lit(1)) - 1))
    orders = flat_table(spark, folder, "orders").join(needed, _col("o_orderkey") == _col("l_orderkey"), "left")
    return orders.select("*", no.alias("no")).select(
        *_HEAD[:-1], (_col("o_orderkey") + _col("no") * REPEAT_ID_STEP).alias("order_id")
    )


def order_pages(spark: SparkSession, folder: str, newest: bool, page_size: int) -> DataFrame:
    """:func:`landed_pages` of the delivered orders, but a document is made where its page is:
    pages are cut on rows without lines, and the lines are shuffled to them before they become
    documents. Documents of orders that share a key come in the order of what these say.
    """
    heads = _order_heads(spark, folder)
    if not newest:
        heads = heads.where(_col("o_orderkey") % 5 == 0)
    order = [_col(name).asc() for name in ("order_id", *_HEAD[:-1])]
    heads = global_rank(heads, order, "position").withColumn("page_no", _page_no(page_size))
    # only the newest version of an order has lines
    lines = numbered_lines(spark, folder) if newest else (
        flat_table(spark, folder, "lineitem").withColumn("order_id", _col("l_orderkey")).where(F.lit(False))
    )
    lines = lines.drop("l_linestatus").withColumnRenamed("order_id", "of_document")
    same = (_col("o_orderkey") == _col("l_orderkey")) & (_col("order_id") == _col("of_document"))
    tasks = _tasks(*[flat_table(spark, folder, name) for name in ("orders", "lineitem")])
    placed = heads.join(lines, same, "left").repartition(tasks, "page_no")
    documents = _line_groups(placed, "page_no", "position", *_HEAD).withColumn("version", F.lit(int(newest)))
    return _bodies(_order_items(documents, "page_no", "position"), PAGED_DOCUMENTS["order"][1])


def delivered_pages(spark: SparkSession, folder: str, entity: str, newest: bool, page_size: int) -> DataFrame:
    """The pages of one delivery of an entity."""
    if entity == "order":
        return order_pages(spark, folder, newest, page_size)
    documents, field = PAGED_DOCUMENTS[entity]
    return landed_pages(delivered(documents(spark, folder), newest), field, page_size)
