"""Commits of a store: two writers, drafts, repeated batches, small parts."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockflow.functions.dates import instant
from stockflow.plans.ingest import IngestJob, pages_to_raw
from stockflow.schemas import PAGE
from stockflow.sources import TableStore
from stockflow.sources.commits import CommitLog
from stockflow.sources.files import create_file, files_in, folders_in, read_file
from stockflow.streaming import stream_pages_to_raw
from stockflow.streaming.pages import append_batch

NOW = datetime(2026, 7, 10, 12)
PRODUCT = IngestJob("product")


def test_a_file_is_created_once(tmp_path):
    path = f"{tmp_path}/log/1"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: create_file(path, str(n)), range(8)))
    assert made.count(True) == 1
    assert read_file(path) == str(made.index(True))
    assert files_in(f"{tmp_path}/log") == ["1"]


def test_writers_at_the_same_time_lose_nothing(tmp_path):
    log = CommitLog(f"{tmp_path}/log")

    def add(n):
        log.commit(lambda now: now.with_tables({"t": [*now.tables.get("t", []), f"t{n}"], f"own{n}": ["x"]}))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(24)))
    newest = log.newest()
    assert newest.number == 24 and len(list(log.history())) == 24
    assert sorted(newest.tables["t"]) == sorted(f"t{n}" for n in range(24))
    log.forget(5)
    assert (log.newest(), len(list(log.history()))) == (newest, 5)


def test_replaces_and_appends_at_the_same_time(spark, store):
    with ThreadPoolExecutor(6) as pool:
        loads = [pool.submit(store.load, "log", spark.range(n, n + 1)) for n in range(4)]
        loads += [pool.submit(store.replace, name, spark.range(3)) for name in ("a", "b")]
        assert all(load.result().ok for load in loads)
    assert sorted(r.id for r in store.read("log").collect()) == [0, 1, 2, 3]
    assert (store.read("a").count(), store.read("b").count()) == (3, 3)


def test_finding_and_switching_a_version_takes_no_job(spark, store):
    store.replace("t", spark.range(3))
    context = spark.sparkContext
    context.setJobGroup("look-up", "look-up")
    try:
        draft = store.draft()
        draft._commit(lambda now: now.with_tables({"u": now.tables["t"]}))
        draft.publish()
        assert store.locations("u") == store.locations("t")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert list(context.statusTracker().getJobIdsForGroup("look-up")) == []


def test_dispositions(spark, store):
    assert store.load("t", spark.range(2), "empty").ok
    failed = store.load("t", spark.range(2), "empty")
    assert (failed.status, store.read("t").count()) == ("failed", 2)
    with pytest.raises(ValueError):
        store.load("t", spark.range(2), "sometimes")


def test_a_plain_folder_is_a_table_too(spark, store):
    spark.range(2).write.parquet(store.path("t"))
    assert store.read("t").count() == 2
    store.load("t", spark.range(3))
    assert store.read("t").count() == 5


def test_a_draft_is_seen_when_it_is_published(spark, store):
    store.replace("a", spark.range(1))
    draft = store.draft()
    store.replace("b", spark.range(9))
    for name, size in (("a", 2), ("c", 3)):
        assert draft.replace(name, spark.range(size)).ok
    assert (draft.read("a").count(), draft.read("c").count()) == (2, 3)
    # others see nothing of it, and it sees nothing that came after it began
    assert store.read("a").count() == 1 and not store.exists("c") and not draft.exists("b")
    with pytest.raises(ValueError):
        draft.load("a", spark.range(1))
    before = store._seen().number
    draft.publish()
    assert store._seen().number == before + 1
    assert [store.read(name).count() for name in "abc"] == [2, 9, 3]


def test_a_folder_that_is_being_written_is_not_superseded(spark, store):
    draft = store.draft()
    for size in (1, 2, 3):
        store.replace("t", spark.range(size))
    draft.replace("t", spark.range(4))
    store.remove_superseded("t")
    assert len([name for name in folders_in(store.root) if name.startswith("t.v-")]) == 3
    draft.publish()
    assert store.read("t").count() == 4


def test_small_parts_are_joined(spark, store):
    most = 0
    for n in range(50):
        assert store.load("log", spark.range(n, n + 1).coalesce(1)).ok
        store.join_small_parts("log", 10)
        store.remove_superseded("log")
        most = max(most, len(folders_in(store.root)))
    assert sorted(r.id for r in store.read("log").collect()) == list(range(50))
    # at most ten parts, the state before, and the folder of commits
    assert most <= 22


def test_joining_gives_way_to_a_replace(spark, store, monkeypatch):
    for n in range(3):
        store.load("t", spark.range(n, n + 1))
    commit = TableStore._commit

    def late(self, change):
        monkeypatch.setattr(TableStore, "_commit", commit)
        store.replace("t", spark.range(7))
        commit(self, change)

    monkeypatch.setattr(TableStore, "_commit", late)
    store.join_small_parts("t", 2)
    assert store.read("t").count() == 7


def test_a_failure_between_rows_and_number_loads_once(spark, store, monkeypatch):
    rows = pages_to_raw(
        spark.createDataFrame([(1, json.dumps({"products": [{"id": 1}, {"id": 2}]}))], PAGE), PRODUCT, instant(NOW)
    )
    commit = TableStore._commit

    def lost(self, change):
        raise OSError("commit lost")

    monkeypatch.setattr(TableStore, "_commit", lost)
    with pytest.raises(RuntimeError, match="commit lost"):
        append_batch(rows, 0, "landing", store, PRODUCT)
    monkeypatch.setattr(TableStore, "_commit", commit)
    assert not store.exists("raw_products")
    for _ in range(2):
        append_batch(rows, 0, "landing", store, PRODUCT)
    assert store.read("raw_products").count() == 2
    # another stream into the same table has numbers of its own
    append_batch(rows, 0, "elsewhere", store, PRODUCT)
    assert store.read("raw_products").count() == 4


def test_a_stream_that_fails_after_its_commit_goes_on(spark, store, tmp_path, monkeypatch):
    for n in range(3):
        body = json.dumps({"products": [{"id": n}]})
        (tmp_path / f"{n}.json").write_text(json.dumps({"page_no": n, "body": body}) + "\n")
    join = TableStore.join_small_parts

    def lost(self, name):
        raise OSError("driver lost")

    monkeypatch.setattr(TableStore, "join_small_parts", lost)
    with pytest.raises(Exception, match="driver lost"):
        stream_pages_to_raw(spark, str(tmp_path), store, PRODUCT, files_per_batch=1).awaitTermination()
    assert store.read("raw_products").count() == 1
    monkeypatch.setattr(TableStore, "join_small_parts", join)
    stream_pages_to_raw(spark, str(tmp_path), store, PRODUCT, files_per_batch=1).awaitTermination()
    assert sorted(r.record_id for r in store.read("raw_products").select(F.col("record_id")).collect()) == ["0", "1", "2"]


def _files(store, name):
    return {f"{part}/{one}" for part in store.locations(name) for one in files_in(part)}


def test_a_merge_leaves_untouched_buckets_alone(spark, store):
    rows = spark.range(200).withColumn("value", F.lit("old"))
    assert store.merge("t", rows, ["id"], buckets=8).rows_loaded == 200
    before = _files(store, "t")
    delta = spark.createDataFrame([(7, "new"), (1000, "new")], "id bigint, value string")
    assert store.merge("t", delta, ["id"], buckets=8).ok
    kept = _files(store, "t") & before
    assert len(before) * 6 / 8 <= len(kept) < len(before)
    found = {r.id: r.value for r in store.read("t").collect()}
    assert store.read("t").columns == ["id", "value"] and store.read("t").count() == 201
    assert {n for n, value in found.items() if value == "new"} == {7, 1000}
    # folders go with the second merge after, and only the buckets that were written again
    for _ in range(2):
        assert store.merge("t", delta, ["id"], buckets=8).ok
        store.remove_superseded("t")
    assert store.read("t").count() == 201 and kept <= _files(store, "t")
    assert store.merge("t", delta, ["id"], buckets=4).status == "failed"


def test_merges_at_the_same_time_lose_nothing(spark, store):
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(lambda n: store.merge("t", spark.range(n, n + 5), ["id"], buckets=2), (0, 5, 10)))
    assert [one.error_message for one in found] == [None] * 3
    assert sorted(r.id for r in store.read("t").collect()) == list(range(15))


def test_an_empty_merge_and_null_keys(spark, store):
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "id bigint, value string")
    assert store.merge("t", rows, ["id"], buckets=2).ok
    assert store.merge("t", rows.where("false"), ["id"], buckets=2).ok
    assert sorted(map(tuple, store.read("t").collect()), key=repr) == [(1, "b"), (None, "a")]
    assert store.merge("t", rows, ["id"], lambda old, new: new.where("false"), 2).ok
    assert store.read_or_empty("t", rows.schema).count() == 0
