import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators import (
    check_not_null,
    check_unique,
    explode_json_array,
    global_rank,
    latest_by,
    latest_of_elements,
    latest_of_wide,
    pivot_fixed,
    unique_winner,
    upsert,
)
from stockflow.operators.pivot import pick_by_name


def test_latest_by_breaks_ties(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "b"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(data, "k string, at int, p string")
    latest = latest_by(df, ["k"], [F.col("at").desc()], [F.col("p").asc()])
    assert rows(latest) == [("a", 2, "b"), (None, 5, "n")]


def test_latest_by_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_by(df, ["k"], [F.col("id").desc()], [])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_explode_json_array_inner_and_outer(spark, rows):
    data = [(1, '{"l":[{"a":1},{"a":2}]}'), (2, '{"l":[]}'), (3, "{}"), (4, '{"l":{"a":1}}')]
    df = spark.createDataFrame(data, "i int, payload string")
    assert rows(explode_json_array(df, "payload", "l", "e"), "i", "e") == [(1, '{"a":1}'), (1, '{"a":2}')]
    outer = explode_json_array(df, "payload", "l", "e", outer=True)
    assert rows(outer, "i", "e") == [(1, '{"a":1}'), (1, '{"a":2}'), (2, None), (3, None), (4, None)]


def test_global_rank_equals_the_window_over_everything(spark, rows):
    # a third of the rows share one value
    df = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 101).alias("score"), "id"
    )
    order = [F.col("score").desc(), F.col("id").asc()]
    expected = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    assert rows(global_rank(df, order, "rank"), "id", "rank") == rows(expected, "id", "rank")


def test_global_rank_of_nothing(spark):
    df = spark.range(0).select("id")
    assert global_rank(df, [F.col("id").asc()], "rank").count() == 0


def test_unique_winner_against_brute_force(spark, rows):
    chance = random.Random(5)
    data = [(chance.randrange(60), chance.choice([None, 1, 2, 3, 4]), i) for i in range(300)]
    data += [(1000, 1, 1000 + i) for i in range(200)] + [(1000, 9, 5000)]
    df = spark.createDataFrame(data, "k int, m int, i int")
    expected = []
    for key in {k for k, _, _ in data}:
        group = [row for row in data if row[0] == key and row[1] is not None]
        best = [row for row in group if row[1] == max(m for _, m, _ in group)]
        expected += best if len(best) == 1 else []
    found = unique_winner(df, ["k"], "m", [F.col("i").asc()])
    assert rows(found) == sorted(expected, key=repr)


def test_pivot_and_lookup_by_name(spark, rows):
    names = (("Oxford St", "oxford"), ("Newtown", "newtown"))
    df = spark.createDataFrame([(1, "Oxford St", 5), (1, "Newtown", 7), (2, "Other", 9)], "k int, n string, q int")
    pivot = pivot_fixed(df, "k", "n", names, {"stock": "q"})
    assert rows(pivot) == [(1, 5, 7), (2, None, None)]
    picked = pivot.select("k", pick_by_name(F.lit("Newtown"), names, "stock"), pick_by_name(F.lit("Other"), names, "stock"))
    assert rows(picked) == [(1, 7, None), (2, None, None)]


def test_upsert_inserts_and_replaces(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows(upsert(target, source, ["k"])) == [("a", 1), ("b", 20), ("c", 30)]


def test_checks_count_failures(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (None, None)], "k int, v string")
    assert rows(check_not_null(df, "m", ["k", "v"])) == [("m", "k", "not_null", 2), ("m", "v", "not_null", 2)]
    # NULLs are no duplicates
    assert rows(check_unique(df, "m", "k")) == [("m", "k", "unique", 1)]


@pytest.mark.parametrize("column", ["k"])
def test_checks_of_an_empty_table(spark, rows, column):
    df = spark.createDataFrame([], "k int")
    assert rows(check_not_null(df, "m", [column])) == [("m", "k", "not_null", 0)]
    assert rows(check_unique(df, "m", column)) == [("m", "k", "unique", 0)]


def test_latest_of_wide_equals_latest_by_of_a_stored_table(spark, store, rows):
    # several files, versions without a time, rows that tie, a key that is NULL
    versions = spark.range(0, 6000, 1, 3).select(
        (F.col("id") % 2500).cast("string").alias("k"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 17 % 13).cast("timestamp")).alias("t"),
        F.concat(F.lit("p"), (F.col("id") * 31 % 1000).cast("string")).alias("payload"),
    )
    alike = spark.sql("SELECT CAST(NULL AS STRING) k, timestamp_seconds(3) t, explode(array('b', 'a', 'a')) payload")
    assert store.replace("versions", versions.union(alike)).ok
    stored = store.read("versions")
    assert stored.select("_metadata.file_path").distinct().count() > 1
    payload = [F.col("payload").asc()]
    expected = rows(latest_by(stored, ["k"], [F.col("t").desc()], payload))
    assert rows(latest_of_wide(stored, ["k"], F.col("t"), payload)) == expected
    assert len(expected) == 2501 and (None, "a") in {(k, p) for k, _, p in expected}
    # rows that are in no files
    assert rows(latest_of_wide(versions, ["k"], F.col("t"), payload)) == rows(
        latest_by(versions, ["k"], [F.col("t").desc()], payload)
    )


def _elements(spark, store, lengths="CASE WHEN id % 400 = 7 THEN 5000 WHEN id % 40 = 3 THEN 70 ELSE id % 6 END"):
    """Rows with arrays, some of them long: elements of several rows, and of one, share a key; some have none."""
    rows = spark.range(0, 1500, 1, 3).selectExpr(
        "id % 701 AS owner",
        "timestamp_seconds(id * 17 % 5) AS t",
        f"transform(sequence(0, {lengths}), n -> concat(if(n % 11 = 5, '', cast(id * 13 % 997 AS string)), ':', n % 9, ':', id * n % 23)) AS items",
    )
    assert store.replace("elements", rows.withColumn("items", F.when(F.col("owner") % 50 != 0, F.col("items")))).ok
    stored = store.read("elements")
    assert stored.select("_metadata.file_path").distinct().count() > 1
    return stored


def _latest_element(rows):
    def described(df):
        return df.withColumn("k", F.nullif(F.split("item", ":")[0], F.lit(""))).withColumn("last", F.split("item", ":")[2])

    order, tiebreak = [F.col("t").desc(), F.col("owner").asc()], [F.col("last").desc(), F.col("item").asc()]
    elements = rows.select("owner", "t", F.explode("items").alias("item"))
    expected = latest_by(described(elements), ["k"], order, tiebreak).select("owner", "t", "item")
    return latest_of_elements(rows, "items", "item", described, described, ["k"], order, tiebreak), expected


def test_latest_of_elements_equals_latest_by_of_all_elements(spark, store, rows):
    found, expected = _latest_element(_elements(spark, store))
    assert rows(found) == rows(expected) and found.count() > 700
    # elements that all have a key of their own, and rows that are in no files
    single = _elements(spark, store, "0")
    for some in (single, spark.createDataFrame(single.limit(50).collect(), single.schema)):
        found, expected = _latest_element(some)
        assert rows(found) == rows(expected)


def test_elements_are_found_by_their_places(spark, store):
    found, expected = _latest_element(_elements(spark, store))
    plan, plain = (df._jdf.queryExecution().optimizedPlan().toString() for df in (found, expected))
    # ranks are over places; whole elements are numbered once, and only those that tie
    assert "bitmap_construct_agg" in plan and plan.count("Window [row_number()") == plain.count("Window [row_number()") == 1
    ranked = [line for line in plan.splitlines() if "Window [rank(" in line]
    narrow = [plan.splitlines()[plan.splitlines().index(line) + 1] for line in ranked]
    assert ranked and not any("item#" in line for line in narrow)
