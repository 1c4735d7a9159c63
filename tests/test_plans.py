"""What the physical plans look like when no table is small enough to broadcast."""

import re

import pytest

from registry.warehouse import open_warehouse
from stockflow.plans.models import MODELS

from tests.conftest import SMALL

# these write an intermediate table and read it back: their plan is that of the read
RANKED = {"store_rotation_recommendations", "store_rotation_report", "store_rotation_workbench"}


@pytest.fixture(scope="module")
def plan_of(spark):
    warehouse = open_warehouse(spark, SMALL)
    for name in MODELS:
        warehouse.model(name)
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in thresholds:
        spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield lambda name: warehouse.model(name)._jdf.queryExecution().executedPlan().toString()
    for key in (*thresholds, "spark.sql.maxMetadataStringLength"):
        spark.conf.unset(key)


@pytest.mark.parametrize("name", MODELS)
def test_no_plan_leaves_the_jvm_or_joins_without_a_key(plan_of, name):
    plan = plan_of(name)
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    if name not in RANKED:
        assert "SinglePartition" not in plan


def scans(plan):
    return plan.count("FileScan parquet")


def test_both_sides_of_pairs_and_both_rankings_share_one_shuffle(plan_of):
    plan = plan_of("store_rotation_candidates")
    assert len(re.findall(r"Exchange hashpartitioning\(variant_id", plan)) == 1
    assert plan.count("Window [") == 3 and scans(plan) == 3


def test_consolidation_reads_each_table_once(plan_of):
    plan = plan_of("style_consolidation_candidates")
    assert scans(plan) == 3
    assert len(re.findall(r"Exchange hashpartitioning\(product_id#\d+L, \d", plan)) <= 2


def test_stock_is_shuffled_once_for_both_lookups_by_variant(plan_of):
    plan = plan_of("variant_location_demand")
    # stock, its sum per variant, sales per variant and name, and those by variant
    assert len(re.findall(r"Exchange hashpartitioning\(variant_id", plan)) == 4


def test_filters_reach_the_files(plan_of):
    recent = plan_of("weeks_of_cover")
    assert "GreaterThanOrEqual(order_created_at" in recent
    assert "ReadSchema: struct<order_created_at:timestamp,variant_id:bigint,quantity:bigint>" in recent
    assert "LessThan(available_quantity,0)" in plan_of("negative_stock_report")
    candidates = plan_of("store_rotation_candidates")
    assert "LessThanOrEqual(warehouse_available_quantity,0)" in candidates


def test_payloads_of_orders_are_parsed_once(plan_of):
    for name, array in (("fact_daily_sales", "refunds"), ("order_lines", "line_items")):
        plan = plan_of(name)
        assert not re.findall(r"FileScan parquet \[[^\]]*payload", plan)
        assert len(re.findall(rf"FileScan parquet \[[^\]]*{array}", plan)) == 1


def test_latest_versions_are_chosen_before_the_shuffle(plan_of):
    for name in ("products", "locations", "inventory_levels", "orders", "order_lines", "product_variants"):
        assert "row_number(), 1, Partial" in plan_of(name)


def test_payloads_of_orders_cross_no_shuffle(plan_of):
    plan = plan_of("orders")
    # rows with the one latest version of their record: read, and their places broadcast
    alone = plan[plan.index("Union") : plan.index("BroadcastExchange")]
    assert "FileScan" in alone and "Exchange hashpartitioning" not in alone
    places = plan[plan.index("BroadcastExchange") :].split("BroadcastHashJoin")[0]
    assert "Exchange hashpartitioning(record_id" in places and "payload" not in places.split("FileScan")[0]


def test_order_lines_cross_the_shuffle_without_their_texts(plan_of):
    below = plan_of("order_lines").partition("Exchange hashpartitioning(order_line_id")[2]
    assert below and " AS sku" not in below and " AS vendor" not in below


def test_levels_are_shuffled_once_for_all_demand(plan_of):
    plan = plan_of("variant_location_demand")
    # the rows of a shuffle are those of the scan below it, if nothing was joined to them before
    wide = [text for text in re.split(r"Exchange hashpartitioning", plan)[1:] if "inventory_item_id" in text.split("FileScan")[0]]
    assert len(wide) <= 1
