import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockflow.functions.dates import instant
from stockflow.plans.ingest import IngestJob, ingest, levels_of_known_items, pages_to_raw, record_run
from stockflow.schemas import PAGE
from stockflow.sources import CursorTable, LoadResult, TableStore, cap_pages, page_items, read_page_files, read_pages
from stockflow.sources.envelope import normalise_phones, updated_since
from stockflow.sources.files import folders_in
from stockflow.streaming import stream_pages_to_raw
from stockflow.streaming.pages import append_batch

NOW = datetime(2026, 7, 10, 12)


def pages(spark, *bodies):
    return spark.createDataFrame([(n, json.dumps(b)) for n, b in enumerate(bodies, start=1)], PAGE)


def payloads(df):
    return [json.loads(row.payload) for row in df.orderBy("record_id").collect()]


def test_customer_page_becomes_raw_rows(spark):
    body = {"customers": [{"id": 123, "email": "a@b.c", "phone": 61419999999, "updated_at": "2026-07-01T00:00:00Z"}]}
    raw = pages_to_raw(pages(spark, body), IngestJob("customer"), instant(NOW)).collect()
    assert [(r.source, r.entity, r.record_id) for r in raw] == [("shop", "customer", "123")]
    assert json.loads(raw[0].payload)["phone"] == "61419999999"


def test_phones_become_text_at_any_depth(spark):
    customer = {
        "id": 1,
        "note": 'she said "phone": 5',
        "telephone": 7,
        "phone": 61400000000,
        "default_address": {"phone": "0400", "zip": 3000},
        "addresses": [{"phone": 5.5}, {"phone": None}, {"city": "x", "contact": {"phone": -1}}],
    }
    df = spark.createDataFrame([(json.dumps(customer),)], "item string")
    found = json.loads(df.select(normalise_phones(F.col("item"))).first()[0])
    assert found == {
        **customer,
        "phone": "61400000000",
        "addresses": [{"phone": "5.5"}, {"phone": None}, {"phone": None, "city": "x", "contact": {"phone": "-1"}}],
    }


@pytest.mark.parametrize(
    ("item", "expected"),
    [("{}", {"phone": None}), (' {"id": 123}', {"id": 123, "phone": None}), ('{"phone":null}', {"phone": None})],
)
def test_missing_phone_is_added(spark, item, expected):
    df = spark.createDataFrame([(item,)], "item string")
    assert json.loads(df.select(normalise_phones(F.col("item"))).first()[0]) == expected


@pytest.mark.parametrize(
    ("item", "expected"),
    [
        ({"phone": "1", "default_address": {}}, {"phone": "1", "default_address": {"phone": None}}),
        ({"default_address": {"city": "x"}, "phone": 5}, {"default_address": {"city": "x", "phone": None}, "phone": "5"}),
        ({"phone": None, "addresses": [], "default_address": None}, {"phone": None, "addresses": [], "default_address": None}),
        ({"phone": None, "addresses": [{}, {"a": 1.50}]}, {"phone": None, "addresses": [{"phone": None}, {"a": 1.5, "phone": None}]}),
    ],
)
def test_addresses_of_customers_have_a_phone(spark, item, expected):
    df = spark.createDataFrame([(json.dumps(item),)], "item string")
    assert json.loads(df.select(normalise_phones(F.col("item"))).first()[0]) == expected


def test_phones_of_other_entities_are_text(spark):
    body = {"orders": [{"id": 1, "phone": 61400, "billing_address": {"phone": 7}}, {"id": 2}]}
    raw = pages_to_raw(pages(spark, body), IngestJob("order"), instant(NOW))
    assert payloads(raw) == [{"id": 1, "phone": "61400", "billing_address": {"phone": "7"}}, {"id": 2}]


def test_items_that_do_not_say_when_they_changed_are_kept(spark, store):
    job, state = IngestJob("order"), CursorTable(store)
    ingest(pages(spark, {"orders": [order(1, "2026-07-02T00:00:00Z")]}), job, store, state, NOW)
    later = [order(2, "2026-07-01T00:00:00Z"), order(3, "soon"), {"id": 4}, order(5, "2026-07-02T00:00:00Z")]
    assert ingest(pages(spark, {"orders": later}), job, store, state, NOW).rows_loaded == 3
    assert sorted(r.record_id for r in store.read(job.table).collect()) == ["1", "3", "4", "5"]


def test_pages_landed_before_the_cursor_are_not_read(spark, store):
    job, state = IngestJob("order"), CursorTable(store)
    ingest(pages(spark, {"orders": [order(1, "2026-07-05T00:00:00Z")]}), job, store, state, NOW)
    old = pages(spark, {"orders": [order(2, "2026-07-05T00:00:00Z")]}).selectExpr("*", "date'2026-07-01' as landed_on")
    new = pages(spark, {"orders": [order(3, "2026-07-05T00:00:00Z")]}).selectExpr("*", "date'2026-07-05' as landed_on")
    assert ingest(old.union(new), job, store, state, NOW).rows_loaded == 1
    assert sorted(r.record_id for r in store.read(job.table).collect()) == ["1", "3"]


def test_pages_without_a_list_and_items_without_an_id(spark):
    bodies = [
        {"locations": {"id": 1}},
        {"other": [{"id": 2}]},
        {"locations": None},
        {"locations": [{"id": 3, "active": True}, {"name": "no id"}, {"id": None}, "text", 7, [1]]},
    ]
    raw = pages_to_raw(pages(spark, *bodies), IngestJob("location"), instant(NOW))
    assert payloads(raw) == [{"id": 3, "active": True}]


def test_level_ids_need_both_parts(spark):
    levels = [{"inventory_item_id": 5, "location_id": 6}, {"inventory_item_id": 5}, {"location_id": 6}]
    raw = pages_to_raw(pages(spark, {"inventory_levels": levels}), IngestJob("inventory_level"), instant(NOW))
    assert [r.record_id for r in raw.collect()] == ["5-6"]


@pytest.mark.parametrize(("cap", "expected"), [(1, [1]), (0, [1]), (2, [1, 2]), (None, [1, 2, 3])])
def test_page_cap_reads_at_least_one_page(spark, cap, expected):
    bodies = [{"orders": [{"id": n}]} for n in (1, 2, 3)]
    items = page_items(cap_pages(pages(spark, *bodies), cap), "orders")
    assert sorted(json.loads(r.item)["id"] for r in items.collect()) == expected


def test_landed_page_files(spark, tmp_path, rows):
    for n in (1, 2):
        (tmp_path / f"orders-page-{n}.json").write_text(json.dumps({"orders": [{"id": n, "x": [1]}]}, indent=1))
    items = page_items(read_page_files(spark, str(tmp_path)), "orders")
    assert rows(items) == [(1, '{"id":1,"x":[1]}'), (2, '{"id":2,"x":[1]}')]


def order(key, updated):
    return {"id": key, "updated_at": updated}


def test_cursor_moves_and_is_inclusive(spark, store):
    job, state = IngestJob("order"), CursorTable(store)
    assert state.get(job.name) is None
    first = [order(1, "2026-07-01T10:00:00+10:00"), order(2, "2026-07-02T00:00:00Z"), order(3, "soon")]
    result = ingest(pages(spark, {"orders": first}), job, store, state, NOW)
    assert (result.status, result.rows_loaded, result.latest) == ("success", 3, datetime(2026, 7, 2))
    assert state.get(job.name) == datetime(2026, 7, 2)

    second = [order(1, "2026-07-01T00:00:00Z"), order(2, "2026-07-02T00:00:00Z"), order(4, "2026-07-03T00:00:00Z")]
    result = ingest(pages(spark, {"orders": second}), job, store, state, datetime(2026, 7, 11))
    assert (result.rows_loaded, state.get(job.name)) == (2, datetime(2026, 7, 3))
    assert store.read(job.table).count() == 5
    assert state.current().count() == 1


def test_cursor_stays_without_rows_or_times(spark, store):
    job, state = IngestJob("product"), CursorTable(store)
    ingest(pages(spark, {"products": []}), job, store, state, NOW)
    ingest(pages(spark, {"products": [{"id": 1}]}), job, store, state, NOW)
    assert state.get(job.name) is None


def test_cursor_stays_after_a_failed_load(spark, store):
    job, state = IngestJob("product"), CursorTable(store)
    broken = pages(spark, {"products": [order(1, "2026-07-01T00:00:00Z")]}).withColumn(
        "body", F.raise_error(F.lit("page lost")).cast("string")
    )
    result = ingest(broken, job, store, state, NOW)
    assert (result.status, result.rows_loaded) == ("failed", 0)
    assert "page lost" in result.error_message
    assert state.get(job.name) is None


def test_entities_without_cursor_are_loaded_in_full(spark, store):
    job, state = IngestJob("location"), CursorTable(store)
    for _ in range(2):
        result = ingest(pages(spark, {"locations": [order(1, "2026-07-01T00:00:00Z")]}), job, store, state, NOW)
        assert result.rows_loaded == 1
    assert state.get(job.name) is None


def test_state_rejects_other_types(store):
    with pytest.raises(TypeError):
        CursorTable(store).save("job", "updated_at", "2026-07-01", NOW)


def test_load_dispositions(spark, store):
    rows_of = spark.range(3)
    assert store.load("t", rows_of, "append").rows_loaded == 3
    assert store.load("t", rows_of, "append").rows_loaded == 3
    assert store.load("t", rows_of, "empty").status == "failed"
    assert store.read("t").count() == 6
    assert store.replace("t", rows_of.limit(1)).rows_loaded == 1
    assert store.read("t").count() == 1


def test_a_failed_replace_keeps_the_old_table(spark, store):
    store.replace("t", spark.range(3))
    lost = spark.range(5).select(F.raise_error(F.lit("executor lost")).cast("bigint").alias("id"))
    result = store.replace("t", lost)
    assert (result.status, result.rows_loaded) == ("failed", 0)
    assert "executor lost" in result.error_message
    assert store.read("t").count() == 3


def test_a_failed_switch_keeps_the_old_table(spark, store, monkeypatch):
    store.replace("t", spark.range(3))

    def broken(self, *version):
        raise OSError("store is away")

    monkeypatch.setattr(TableStore, "_commit", broken)
    result = store.replace("t", spark.range(9))
    assert (result.status, result.error_message) == ("failed", "store is away")
    assert store.read("t").count() == 3


def test_a_reader_that_began_before_a_replace_finishes(spark, store):
    store.replace("t", spark.range(3))
    began = store.read("t")
    store.replace("t", spark.range(5))
    store.remove_superseded("t")
    assert (began.count(), store.read("t").count()) == (3, 5)
    store.replace("t", spark.range(7))
    store.remove_superseded("t")
    assert [name.split(".")[1][:2] for name in folders_in(store.root)].count("v-") == 2
    assert store.read("t").count() == 7


def test_rows_are_appended_to_the_newest_version(spark, store):
    store.load("t", spark.range(2))
    store.replace("t", spark.range(3))
    store.load("t", spark.range(4))
    assert store.read("t").count() == 7


def test_a_table_can_be_replaced_from_itself(spark, store):
    store.replace("t", spark.range(3))
    assert store.replace("t", store.read("t").where("id > 0")).rows_loaded == 2
    assert store.read("t").count() == 2


def test_run_history_is_appended(spark, store):
    for result in (LoadResult("t", "success", 5), LoadResult("t", "failed", 0, "no")):
        record_run(store, "shop-orders", NOW, datetime(2026, 7, 10, 12, 1), result)
    found = sorted(tuple(r) for r in store.read("job_history").select("status", "rows_processed", "duration_seconds", "message").collect())
    assert found == [("failed", 0, 60.0, "no"), ("success", 5, 60.0, None)]


def test_levels_of_known_items_only(spark):
    raw = pages_to_raw(
        pages(spark, {"inventory_levels": [{"inventory_item_id": n, "location_id": 1} for n in (1, 2, 2)]}),
        IngestJob("inventory_level"),
        instant(NOW),
    )
    variants = spark.createDataFrame([(2,), (2,), (None,)], "inventory_item_id bigint")
    assert [r.record_id for r in levels_of_known_items(raw, variants).collect()] == ["2-1", "2-1"]


def test_stream_loads_each_file_once(spark, store, tmp_path):
    job = IngestJob("product")
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, *keys):
        body = {"products": [{"id": k} for k in keys]}
        (landing / name).write_text(json.dumps({"page_no": 1, "body": body}) + "\n")

    def ids():
        return sorted(r.record_id for r in store.read(job.table).collect())

    land("a.json", 1, 2)
    stream_pages_to_raw(spark, str(landing), store, job, files_per_batch=1).awaitTermination()
    assert ids() == ["1", "2"]
    land("b.json", 3)
    stream_pages_to_raw(spark, str(landing), store, job).awaitTermination()
    assert ids() == ["1", "2", "3"]
    assert read_pages(spark, str(landing)).count() == 2


@pytest.mark.parametrize("stream_first", [True, False])
def test_streamed_and_batch_loaded_rows_are_one_table(spark, store, tmp_path, stream_first):
    job = IngestJob("product")
    (tmp_path / "a.json").write_text(json.dumps({"page_no": 1, "body": {"products": [{"id": 1}]}}) + "\n")
    batch = pages(spark, {"products": [order(2, "2026-07-02T00:00:00Z"), order(3, "2026-07-01T00:00:00Z")]})
    for stream in (stream_first, not stream_first):
        if stream:
            stream_pages_to_raw(spark, str(tmp_path), store, job).awaitTermination()
        else:
            assert ingest(batch, job, store, CursorTable(store), NOW).ok
    assert sorted(r.record_id for r in store.read(job.table).collect()) == ["1", "2", "3"]


def test_a_repeated_micro_batch_is_loaded_once(spark, store):
    rows = pages_to_raw(pages(spark, {"products": [{"id": 1}]}), IngestJob("product"), instant(NOW))
    for _ in range(2):
        append_batch(rows, 0, "landing", store, IngestJob("product"))
    append_batch(rows, 1, "landing", store, IngestJob("product"))
    assert store.read("raw_products").count() == 2


def test_store_is_a_plain_value(spark):
    assert TableStore(spark, "/x").path("t") == "/x/t"


def test_the_time_of_change_is_read_once(spark, rows):
    """A filter reads its text as often as the plan names it."""
    items = spark.createDataFrame(
        [(1, '{"updated_at":"2026-01-01T00:00:00Z"}'), (2, '{"updated_at":"2026-03-01T00:00:00Z"}'), (3, "{}"), (4, '{"updated_at":"x"}')],
        "page_no int, item string",
    )
    changed = updated_since(items, datetime(2026, 2, 1))
    assert [no for no, _ in rows(changed)] == [2, 3, 4]
    condition = changed._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert condition.count("$.updated_at") == 1
