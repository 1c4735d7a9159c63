"""The feed at size: documents are built once, from narrow rows, and spread over tasks."""

from stockflow.sources import feed
from stockflow.sources.files import folders_in
from tests.conftest import SMALL


def plan(df, kind):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_a_customer_is_parsed_a_few_times_only(spark):
    text = plan(feed.raw_customers(spark, SMALL), "optimizedPlan")
    assert text.count("parse_json") <= 2
    # the filter on the id does not repeat the phones
    assert all("variant_get" not in line for line in text.splitlines() if "Filter" in line)


def test_documents_of_one_small_file_are_spread(spark):
    for documents in (feed.customer_documents, feed.product_documents):
        assert documents(spark, SMALL).rdd.getNumPartitions() == 8


def test_orders_are_shuffled_as_narrow_rows_once(spark):
    # lines by their order, and orders to join them; no part of a document
    assert plan(feed.order_documents(spark, SMALL), "executedPlan").count("Exchange") == 2


def test_crowded_orders_give_the_same_documents(spark, rows, monkeypatch):
    together = rows(feed.order_documents(spark, SMALL))
    monkeypatch.setattr(feed, "CROWDED", 5)
    spread = feed.order_documents(spark, SMALL)
    assert "position" in plan(spread, "optimizedPlan")
    assert rows(spread) == together
    assert len(together) == len(set(together))


def test_tables_are_written_small(spark, store):
    assert store.replace("numbers", spark.range(10)).ok
    folder = store.locations("numbers")[0]
    names = [row[0] for row in spark.read.format("binaryFile").load(folder).select("path").collect()]
    assert folders_in(store.root) and names and all(name.endswith(".zstd.parquet") for name in names)


def test_files_of_a_table_have_bounded_rows(spark, store):
    assert store.replace("numbers", spark.range(0, 250_000, 1, 1)).ok
    files = store.read("numbers").groupBy("_metadata.file_path").count().select("count").collect()
    assert sorted(row[0] for row in files) == [50_000, 100_000, 100_000]


def test_a_document_is_made_once(spark):
    # the filter on the id does not make it a second time
    for raw in (feed.raw_products, feed.raw_inventory_levels, feed.raw_orders):
        assert plan(raw(spark, SMALL), "optimizedPlan").count("StructsToJsonEvaluator") == 1


def test_tables_are_written_at_a_high_level(spark, store):
    def written(path):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        return files.agg({"length": "sum"}).first()[0]

    raw = feed.raw_orders(spark, SMALL).coalesce(1)
    assert store.replace("orders", raw).ok
    raw.write.option("compression", "zstd").parquet(store.path("plain"))
    assert written(store.locations("orders")[0]) < 0.95 * written(store.path("plain"))


def test_pages_of_orders_are_those_of_the_documents(spark, rows, monkeypatch):
    for newest in (False, True):
        documents = feed.delivered(feed.order_documents(spark, SMALL), newest)
        expected = rows(feed.landed_pages(documents, "orders", 7))
        assert rows(feed.order_pages(spark, SMALL, newest, 7)) == expected and len(expected) > 10
    monkeypatch.setattr(feed, "CROWDED", 5)
    assert rows(feed.order_pages(spark, SMALL, True, 7)) == expected


def test_documents_of_landed_orders_cross_no_shuffle(spark):
    pages = plan(feed.order_pages(spark, SMALL, True, 250), "executedPlan")
    made = pages.index("StructsToJsonEvaluator") if "StructsToJsonEvaluator" in pages else pages.index("to_json")
    # the tree is printed from its root on: what stands before the making of documents comes after it
    assert "Exchange" not in pages[:made]
