"""Models over a handful of hand-written documents."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from stockflow.config import RetailConfig
from stockflow.functions.dates import instant
from stockflow.plans import sales, staging, stock
from stockflow.plans.ingest import IngestJob, pages_to_raw
from stockflow.schemas import PAGE

CFG = RetailConfig(as_of=datetime(2026, 7, 1))


def raw(spark, entity, *documents, at=datetime(2026, 7, 1)):
    job = IngestJob(entity)
    page = spark.createDataFrame([(1, json.dumps({job.page_field: list(documents)}))], PAGE)
    return pages_to_raw(page, job, instant(at))


def by(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def staged_orders(spark, *documents):
    return staging.orders({"raw_orders": raw(spark, "order", *documents)}, CFG)


def test_latest_version_of_a_product(spark):
    old = raw(spark, "product", {"id": 1, "title": "old", "variants": [{"id": 9}]}, at=datetime(2026, 6, 1))
    new = raw(spark, "product", {"id": 1, "title": "new", "variants": [{"id": 11, "price": "5.5"}, {"id": 12, "price": "x"}]})
    products = staging.products({"raw_products": old.union(new)}, CFG)
    assert by(products, "product_id", "product_key", "product_title") == [(1, "1", "new")]
    variants = staging.product_variants({"products": products}, CFG)
    assert by(variants, "variant_id", "variant_key", "price", "product_title") == [
        (11, "11", Decimal("5.500000000"), "new"),
        (12, "12", None, "new"),
    ]


def test_order_lines_references(spark):
    lines = [
        {"id": 1, "product_id": 7, "sku": "A", "quantity": 2, "price": "3.10", "total_discount": "0.20"},
        {"id": 2, "product_id": None, "sku": "B", "quantity": "x"},
        {"id": 3, "sku": ""},
        {"id": 4},
    ]
    orders = staged_orders(spark, {"id": 5, "tags": "vip, Location Smith St, web", "line_items": lines})
    found = staging.order_lines({"orders": orders}, CFG)
    assert by(found, "order_line_id", "product_reference_status", "product_key", "quantity") == [
        (1, "product", "7", 2),
        (2, "sku_only", "B", None),
        (3, "non_product_item", "", None),
        (4, "non_product_item", None, None),
    ]
    facts = sales.fact_sales({"order_lines": found, "orders": orders}, CFG)
    assert by(facts.where("order_line_id = 1"), "net_sales", "sales_location_name") == [
        (Decimal("6.000000000"), "Smith St")
    ]


def test_a_line_that_moved_between_orders_is_kept_once(spark):
    orders = staged_orders(
        spark,
        {"id": 1, "updated_at": "2026-06-01T00:00:00Z", "line_items": [{"id": 50, "quantity": 1}]},
        {"id": 2, "updated_at": "2026-06-02T00:00:00Z", "line_items": [{"id": 50, "quantity": 2}]},
    )
    assert by(staging.order_lines({"orders": orders}, CFG), "order_id", "quantity") == [(2, 2)]


def test_orders_without_lines_or_with_odd_ones(spark):
    orders = staged_orders(
        spark, {"id": 1, "line_items": []}, {"id": 2}, {"id": 3, "line_items": {"id": 9}}, {"id": "4x", "line_items": None}
    )
    assert by(orders, "order_id") == [(1,), (2,), (3,), (None,)]
    assert staging.order_lines({"orders": orders}, CFG).count() == 0


def locations(spark):
    columns = "location_id long, location_name string, sales_location_name string"
    data = [(1, "Flinders Lane", "Melbourne"), (2, "Fitzroy", "Fitzroy"), (3, "Back room", None)]
    return spark.createDataFrame(data, columns)


def test_daily_sales_with_refunds(spark):
    orders = staged_orders(
        spark,
        # 15:00 UTC on the 1st is the 2nd in Melbourne
        {
            "id": 1, "created_at": "2026-06-01T15:00:00Z", "tags": "Location Melbourne", "subtotal_price": "100",
            "total_discounts": "10", "total_tax": "9.5",
            "shipping_lines": [{"price": "8", "discounted_price": "5"}, {"price": "2"}, {"price": "free"}],
            "refunds": [
                {
                    "processed_at": "2026-06-05T00:00:00Z",
                    "refund_line_items": [
                        {"location_id": 2, "subtotal": "20", "total_tax": "2", "quantity": 1},
                        {"subtotal": "30", "total_tax": "bad", "quantity": 2},
                    ],
                    "transactions": [{"location_id": 1}, {"location_id": 3}],
                },
                {"processed_at": "2026-06-05T00:00:00Z", "transactions": [{"location_id": 77}]},
                {"processed_at": "whenever", "refund_line_items": [{"subtotal": "999"}]},
            ],
        },
        {"id": 2, "created_at": "2026-06-02T01:00:00Z", "tags": "Location Melbourne", "subtotal_price": "1",
         "total_discounts": "0", "total_tax": "0"},
        {"id": 3, "created_at": "2026-06-02T01:00:00Z", "tags": "Location Popup", "subtotal_price": "7",
         "total_discounts": "0", "total_tax": "0"},
        {"id": 4, "created_at": "2026-06-02T01:00:00Z", "subtotal_price": "4", "total_discounts": "0", "total_tax": "0"},
        {"id": 5, "created_at": "2026-06-02T01:00:00Z", "cancelled_at": "2026-06-02T02:00:00Z", "subtotal_price": "500",
         "refunds": [{"processed_at": "2026-06-05T00:00:00Z", "refund_line_items": [{"subtotal": "500"}]}]},
        {"id": 6, "created_at": "no date", "subtotal_price": "5"},
    )
    daily = sales.fact_daily_sales({"orders": orders, "dim_locations": locations(spark)}, CFG)
    found = {
        (r.trading_date, r.location_id, r.location_name): tuple(
            float(r[c]) for c in ("gross_sales", "discounts", "returns", "shipping_sales", "taxes", "total_sales")
        ) + (r.order_count, r.returned_units)
        for r in daily.collect()
    }
    second, fifth = date(2026, 6, 2), date(2026, 6, 5)
    assert found == {
        (second, 1, "Flinders Lane"): (111, 10, 0, 7, 9.5, 117.5, 2, 0),
        (second, None, "Popup"): (7, 0, 0, 0, 0, 7, 1, 0),
        (second, None, "Unknown"): (4, 0, 0, 0, 0, 4, 1, 0),
        (fifth, 2, "Fitzroy"): (0, 0, 20, 0, -2, -22, 0, 1),
        (fifth, 1, "Flinders Lane"): (0, 0, 30, 0, 0, -30, 0, 2),
        # a refund without lines counts at the place of its first transaction
        (fifth, 77, "Unknown"): (0, 0, 0, 0, 0, 0, 0, 0),
    }


def test_customers_sharing_an_email(spark):
    customers = staging.customers(
        {
            "raw_customers": raw(
                spark, "customer",
                {"id": 1, "email": "A@x.com", "first_name": "Ann", "updated_at": "2026-01-01T00:00:00Z"},
                {"id": 1, "email": "a@x.com", "first_name": "Anna", "updated_at": "2026-02-01T00:00:00Z"},
                {"id": 2, "email": "a@X.com", "last_name": "B"},
                {"id": 3, "email": None},
                {"id": 4},
            )
        },
        CFG,
    )
    assert customers.count() == 5
    facts = spark.createDataFrame(
        [
            (10, "a@x.COM", 2, Decimal("5"), datetime(2026, 3, 1)),
            (10, "a@x.COM", 1, Decimal("1"), datetime(2026, 3, 1)),
            (11, "A@X.com", 1, Decimal("2.5"), datetime(2026, 4, 1)),
            (12, None, 9, Decimal("9"), datetime(2026, 4, 1)),
        ],
        "order_id long, customer_email string, quantity long, net_sales decimal(38,9), order_created_at timestamp",
    )
    found = sales.dim_customers({"customers": customers, "fact_sales": facts}, CFG)
    columns = ("customer_id", "full_name", "warehouse_orders_count", "lifetime_units_sold", "lifetime_net_sales")
    zero, spent = Decimal("0E-9"), Decimal("8.500000000")
    assert by(found, *columns) == [(1, "Anna", 2, 4, spent), (2, "B", 2, 4, spent), (3, "", 0, 0, zero), (4, "", 0, 0, zero)]


@pytest.mark.parametrize(
    ("available", "sold", "expected"),
    [
        (-1, 5, "negative_stock"), (0, 5, "out_of_stock"), (3, 0, "no_recent_sales"), (1, 5, "low_cover"),
        (20, 5, "overstocked"), (5, 5, "healthy"),
    ],
)
def test_stock_status(spark, available, sold, expected):
    columns = ("location_id", "location_name", "product_id", "variant_id", "product_title", "variant_title", "sku",
               "vendor", "product_type", "product_status")
    inventory = spark.createDataFrame(
        [(1, "Fitzroy", 1, 1, *["x"] * 6, available)],
        ", ".join(f"{c} {'long' if c.endswith('_id') else 'string'}" for c in columns) + ", available_quantity long",
    )
    facts = spark.createDataFrame(
        [(1, sold, datetime(2026, 6, 1)), (1, 100, datetime(2026, 5, 31, 23))],
        "variant_id long, quantity long, order_created_at timestamp",
    )
    row = stock.weeks_of_cover({"fact_inventory_snapshot": inventory, "fact_sales": facts}, CFG).first()
    assert (row.stock_status, row.units_sold_30_days) == (expected, sold)
    if sold:
        assert row.raw_weeks_of_cover == available / (sold / 4.2857)


def test_location_kinds(spark):
    columns = "location_id long, location_name string, city string, province string, country string, is_active boolean"
    names = [("Online / Warehouse", True), ("Sparehouse", True), ("Flinders Lane", True), ("Fitzroy", None), (None, True)]
    df = spark.createDataFrame([(i, n, "c", "p", "au", a) for i, (n, a) in enumerate(names)], columns)
    found = sales.dim_locations({"locations": df}, CFG)
    assert by(found, "location_id", "sales_location_name", "location_type") == [
        (0, "Warehouse", "warehouse"),
        (1, None, "internal"),
        (2, "Melbourne", "store"),
        (3, "Fitzroy", "inactive"),
        (4, None, "store"),
    ]


def test_demand_of_levels_without_a_variant_or_a_product(spark):
    levels = spark.createDataFrame(
        [
            (1, "Fitzroy", 7, 70, 4),
            (0, CFG.warehouse, 7, 70, 5),
            (1, "Fitzroy", 8, 70, 6),  # the same variant under another product
            (1, "Fitzroy", 7, None, 2),
            (0, CFG.warehouse, 7, None, 9),
            (1, "Fitzroy", None, 70, 1),
            (2, "Nowhere", 9, 90, 3),
        ],
        "location_id long, location_name string, product_id long, variant_id long, available_quantity long",
    ).selectExpr(
        "*",
        *[f"1L AS {name}" for name in ("inventory_item_id", "inventory_level_key", "inventory_level_updated_at", "modelled_at")],
        *[f"'x' AS {name}" for name in ("product_title", "variant_title", "sku", "vendor", "product_type", "product_status", "city")],
    )
    sold = spark.createDataFrame(
        [(70, "fitz", 2), (70, "fitz", 1), (70, "popup", 50), (None, "fitz", 8), (90, None, 5)],
        "variant_id long, sales_location_name string, quantity long",
    ).selectExpr("*", "timestamp'2026-06-30 00:00:00' AS order_created_at")
    style = spark.createDataFrame(
        [(7, "Fitzroy", 11, 12, 1.5), (8, "Fitzroy", 21, 22, 2.5), (None, "Fitzroy", 31, 32, 3.5)],
        "product_id long, location_name string, style_units_4_weeks long, style_units_12_weeks long, demand_score double",
    )
    names = spark.createDataFrame(
        [(1, "fitz"), (0, None), (2, None)], "location_id long, sales_location_name string"
    )
    found = stock.variant_location_demand(
        {"fact_inventory_snapshot": levels, "fact_sales": sold, "style_location_demand": style, "dim_locations": names}, CFG
    )
    columns = ("location_id", "product_id", "variant_id", "units_sold_4_weeks", "style_units_sold_4_weeks", "warehouse_available_quantity")
    assert by(found, *columns) == sorted(
        [
            (1, 7, 70, 3, 11, 5),
            (0, 7, 70, 0, 0, 5),
            (1, 8, 70, 3, 21, 5),
            (1, 7, None, 0, 11, 0),
            (0, 7, None, 0, 0, 0),
            (1, None, 70, 3, 0, 5),
            (2, 9, 90, 0, 0, 0),
        ],
        key=repr,
    )
