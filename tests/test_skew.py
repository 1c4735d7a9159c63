"""A third of all rows under one key: results stay whole, groups are split."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from registry.compare import connect, differences
from stockflow.sources import feed

from tests.conftest import SMALL

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
NAMES = [
    "stg_orders",
    "stg_order_lines",
    "fact_sales",
    "dim_products",
    "dim_customers",
    "fact_daily_sales",
    "style_demand",
    "variant_demand",
    "weeks_of_cover",
    "rotation_report",
    "consolidation",
    "json_array_explode",
    "nested_unnest",
    "latest_by_two_keys",
    "qualify_latest",
    "single_best_line",
    "whole_table_rank",
    "left_expr_join",
    "distinct_counts",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables, but every third line item in one order, of one product, and
    every third order of one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    for file in Path(SMALL).glob("*.parquet"):
        if file.stem not in ("lineitem", "orders"):
            shutil.copyfile(file, folder / file.name)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    hot = F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice") % 3 == 0
    lines.withColumns(
        {
            "l_orderkey": F.when(hot, F.lit(4)).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(hot, F.lit(22)).otherwise(F.col("l_partkey")),
        }
    ).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(8)).otherwise(F.col("o_custkey"))
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def connection(skewed):
    import duckdb

    found = connect(SMALL)
    for name in ("lineitem", "orders"):
        found.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{skewed}/{name}.parquet/*.parquet'")
    assert isinstance(found, duckdb.DuckDBPyConnection)
    return found


@pytest.mark.parametrize("name", NAMES)
def test_results_under_skew(spark, skewed, connection, name):
    assert differences(QUERIES[name](spark, skewed), connection, SQL[name]) == []


def test_lines_of_a_huge_order_are_spread(spark, skewed):
    lines = feed.numbered_lines(spark, skewed)
    per_document = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("l_linenumber").alias("numbers")
    )
    assert per_document.agg(F.sum("lines")).first()[0] == spark.read.parquet(f"{skewed}/lineitem.parquet").count()
    assert per_document.where("lines <> numbers").count() == 0
    # document n of an order has at least the line numbers of document n + 1
    assert lines.where("l_orderkey = 4").select("order_id").distinct().count() > 100
