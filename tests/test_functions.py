import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.functions import (
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
)
from stockflow.functions.casts import money_times_units, total
from stockflow.functions.text import matches


def evaluate(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in found]


def test_safe_long(spark):
    assert evaluate(spark, safe_long, ["12", "-3", "1.5", "x", "", None]) == [12, -3, None, None, None, None]


def test_safe_money_keeps_nine_decimals(spark):
    found = evaluate(spark, safe_money, ["1.123456789", "-2", "n/a", None])
    assert found == [Decimal("1.123456789"), Decimal("-2.000000000"), None, None]


def test_money_arithmetic_loses_no_scale(spark):
    df = spark.createDataFrame([("0.123456789", 3), ("999999999999.000000001", 1)], "p string, q bigint")
    net = money_times_units(safe_money(F.col("p")), F.col("q")) - safe_money(F.lit("0.000000001"))
    assert df.select(total(net).alias("s")).first().s == Decimal("999999999999.370370366")


def test_money_has_29_digits_before_the_point(spark):
    found = evaluate(spark, safe_money, ["99999999999999.50", "12345678901234567890123456789.5", "1e30"])
    assert found == [Decimal("99999999999999.500000000"), Decimal("12345678901234567890123456789.500000000"), None]
    df = spark.createDataFrame([("1234567890123456.25", 4_000_000_000)], "p string, q bigint")
    net = money_times_units(safe_money(F.col("p")), F.col("q"))
    assert df.select(total(net).alias("s")).first().s == Decimal("4938271560493825000000000.000000000")


def test_safe_bool_takes_only_two_words(spark):
    found = evaluate(spark, safe_bool, ["true", "FALSE", "yes", "1", "t", "", None])
    assert found == [True, False, None, None, None, None, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-07-01T10:00:00+10:00", "2026-07-01 00:00:00"),
        ("2026-07-01T10:00:00Z", "2026-07-01 10:00:00"),
        ("2026-07-01 10:00:00", "2026-07-01 10:00:00"),
        ("2026-07-01", "2026-07-01 00:00:00"),
        ("2026", None),
        ("2026-07", None),
        ("12:30:00", None),
        ("pending", None),
        ("", None),
        (None, None),
    ],
)
def test_safe_ts_needs_a_full_date(spark, text, expected):
    found = evaluate(spark, lambda v: F.date_format(safe_ts(v), "yyyy-MM-dd HH:mm:ss"), [text])
    assert found == [expected]


def test_safe_divide(spark):
    df = spark.createDataFrame([(5, 2), (5, 0), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_divide(F.col("a"), F.col("b"))).collect()] == [2.5, None, None]


def test_trim_takes_all_white_space(spark):
    assert evaluate(spark, trim_blanks, ["\t a b \n", " x　", "   ", None]) == ["a b", "x", "", None]


def test_has_tag_ignores_case_and_blanks(spark):
    tags = ["all, Season_AW26 , x", "season_aw26\n", "season_aw26x", "", None]
    assert evaluate(spark, lambda v: has_tag(v, "SEASON_AW26"), tags) == [True, True, False, False, False]


def test_extract_first_gives_null_without_match(spark):
    found = evaluate(spark, lambda v: extract_first(v, r"Location ([^,]+)"), ["a, Location Fitzroy, b", "web", None])
    assert found == ["Fitzroy", None, None]


def test_matches_only_at_the_very_end(spark):
    pattern = r"(^|,\s*)classics(\s*,|\z)"
    found = evaluate(spark, lambda v: matches(v, pattern), ["x, CLASSICS", "classics ,y", "classics\n", "classicsx", None])
    assert found == [True, True, False, False, False]


def test_local_date_follows_daylight_saving(spark):
    # 13:30 UTC is the next day in Melbourne in January, but not in July
    found = evaluate(
        spark,
        lambda v: local_date(v.cast("timestamp"), "Australia/Melbourne"),
        ["2026-01-10 13:30:00", "2026-07-10 13:30:00", "2026-07-10 14:00:00"],
    )
    assert found == [date(2026, 1, 11), date(2026, 7, 10), date(2026, 7, 11)]


def test_days_between(spark):
    df = spark.createDataFrame([(date(2026, 3, 1), date(2026, 2, 27))], "a date, b date")
    assert df.select(days_between(F.col("a"), F.col("b"))).first()[0] == 2


PAYLOADS = [
    {"a": "x", "n": 61419999999, "f": 1.50, "b": True, "o": {"k": "v"}, "l": [1]},
    {"a": None, "o": "{\"k\": 1}", "l": "[SALE] Socks", "d": {"e": {"k": 1}}},
    {"a": {"deep": 1}, "d": {"e": "inner"}},
    {"d": "no object"},
]


def test_scalars_are_text_and_nested_values_null(spark):
    df = spark.createDataFrame([(json.dumps(p),) for p in PAYLOADS] + [("not json",), (None,)], "payload string")
    paths = {"a": "a", "n": "n", "b": "b", "o": "o", "l": "l", "e": "d.e"}
    found = [tuple(r) for r in parse_payload(df, "payload", paths, []).collect()]
    assert found == [
        ("x", "61419999999", "true", None, None, None),
        # texts that only look like JSON stay
        (None, None, None, "{\"k\": 1}", "[SALE] Socks", None),
        (None, None, None, None, None, "inner"),
        (None,) * 6,
        (None,) * 6,
        (None,) * 6,
    ]


def test_json_list(spark):
    payloads = ['{"l": [{"a": 1}, 2, "x"]}', '{"l": {}}', '{"l": []}', "{}", '{"l": null}']
    assert evaluate(spark, lambda v: json_list(v, "l"), payloads) == [['{"a":1}', "2", "x"], None, [], None, None]
