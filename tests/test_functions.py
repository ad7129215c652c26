from __future__ import annotations

from datetime import date, datetime

import pytest
from plans import plan_text
from pyspark.sql import functions as F

from driftline.functions import predicates as p
from driftline.functions import scalar as s


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "size,text",
    [
        (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10752, "11 kB"), (10485247, "10239 kB"),
        (10485248, "10 MB"), (3221225472, "3072 MB"), (10737418240, "10 GB"), (1 << 50, "1024 TB"), (1 << 60, "1024 PB"),
    ],
)
def test_pretty_size(spark, size, text):
    assert one(spark, s.pretty_size(F.lit(size))) == text


@pytest.mark.parametrize(
    "seconds,text",
    [(0, "0:00:00"), (59, "0:00:59"), (3661, "1:01:01"), (86399, "23:59:59"), (90061, "1 day, 1:01:01"), (172800, "2 days, 0:00:00")],
)
def test_clock_time(spark, seconds, text):
    assert one(spark, s.clock_time(F.lit(seconds))) == text


def test_dates(spark):
    assert one(spark, s.date_from_parts(F.lit(1999), F.lit(3), F.lit(7))) == date(1999, 3, 7)
    assert one(spark, s.date_from_parts(F.lit(1999), F.lit(2), F.lit(30))) is None
    assert one(spark, s.date_from_parts(F.lit(None).cast("int"), F.lit(2), F.lit(3))) is None
    assert one(spark, s.month_start(F.lit(datetime(2020, 5, 17, 3)))) == date(2020, 5, 1)


def test_epoch_ignores_session_zone(spark):
    stamp = F.lit("2024-07-01 00:00:00.25").cast("timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, s.epoch_text(stamp)) == "1719792000.250000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, s.epoch_text(F.lit("1969-12-31 23:59:59").cast("timestamp_ntz"))) == "-1.000000"


def test_text_helpers(spark):
    assert one(spark, s.base_name(F.lit("/a/b/US1.dly"))) == "US1"
    assert one(spark, s.base_name(F.lit("file:/x/part.csv.gz"), 2)) == "part"
    assert one(spark, s.blank_to_null(F.lit("   "))) is None
    assert one(spark, s.fixed_slice(F.lit("abcdef"), 2, 3)) == "cde"
    assert one(spark, s.array_length(F.array().cast("array<string>"))) is None
    assert one(spark, s.parse_text_array(F.lit("not an array"))) is None
    assert one(spark, s.parse_text_array(F.lit('{"a, b",null,"NULL",x}'))) == ["a, b", None, "NULL", "x"]


def test_ratios(spark):
    assert one(spark, s.ratio(F.lit(1), F.lit(0))) is None
    assert str(one(spark, s.percent(F.lit(1), F.lit(3)))) == "33.33"
    assert str(one(spark, s.percent(F.lit(3), F.lit(3)))) == "100.00"
    assert str(one(spark, s.rounded_mean(F.lit(5), F.lit(2)))) == "2.50"


def test_bucket_edges(spark):
    def bucket(v, low=0.0, high=10.0):
        return one(spark, s.equal_width_bucket(F.lit(float(v)), F.lit(low), F.lit(high), 20))

    assert [bucket(v) for v in (-1, 0, 0.5, 9.99, 10, 11)] == [0, 1, 2, 20, 21, 21]
    assert bucket(1, 1.0, 1.0) is None


def test_labels(spark):
    bands = [(1, "none"), (50, "low")]
    assert one(spark, s.value_bands(F.lit(0), bands, "high")) == "none"
    assert one(spark, s.value_bands(F.lit(50), bands, "high")) == "high"
    assert one(spark, s.value_bands(F.lit(None).cast("int"), bands, "high")) is None
    assert one(spark, s.lookup(F.lit(9), {1: "a"}, "z")) == "z"
    assert one(spark, s.flag_label(F.lit(None).cast("boolean"), "t", "f")) == "f"


DOC = '{"version": 1, "settings": {"timeout": 1000, "on": true, "list": ["a", "b"]}, "settings.timeout": "dotted", "n": null}'


def test_json_paths(spark):
    assert one(spark, s.json_text(F.lit(DOC), "settings.timeout")) == "1000"
    assert one(spark, s.json_text(F.lit(DOC), "settings.timeout", literal_key=True)) == "dotted"
    assert one(spark, s.json_text(F.lit(DOC), "n")) is None
    assert one(spark, s.json_text(F.lit(DOC), "absent")) is None


@pytest.mark.parametrize(
    "pattern,expected",
    [
        ({"version": 1}, True),
        ({"version": "1"}, False),
        ({"version": 1.0}, True),
        ({"settings": {"timeout": 1000, "on": True}}, True),
        ({"settings": {"list": ["b"]}}, True),
        ({"settings": {"list": ["b", "c"]}}, False),
        ({"missing": 1}, False),
        ({}, True),
    ],
)
def test_json_contains(spark, pattern, expected):
    assert one(spark, p.json_contains(F.lit(DOC), pattern)) is expected


def test_array_predicates(spark):
    items = F.array(F.lit("a"), F.lit("b"))
    assert one(spark, p.array_has_all(items, ["a", "b"])) is True
    assert one(spark, p.array_has_all(items, ["a", "c"])) is False
    assert one(spark, p.array_has_any(items, ["x", "b"])) is True


def test_row_predicates(spark):
    df = spark.createDataFrame([(1, "ab", 5), (2, "ac", None), (3, "bc", 7)], "a int, t string, n int")
    assert df.filter(p.matches_all(a=[1, 2], n=(4, 6))).count() == 1
    assert df.filter(p.both_present("a", "n")).count() == 2
    assert df.filter(p.half_open("a", 1, 3)).count() == 2
    assert df.filter(p.text_prefix("t", "a")).count() == 2


@pytest.mark.parametrize("text,ok", [("0.0.0.0", True), ("255.1.2.3", True), ("256.1.1.1", False), ("1.2.3", False)])
def test_ipv4(spark, text, ok):
    assert one(spark, p.is_ipv4(F.lit(text))) is ok


def test_wall_clock_range_is_pushed_down_in_any_zone(spark, tmp_path):
    hours = spark.range(48).select((F.lit("2024-07-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, id)")).alias("t"))
    hours.write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = spark.read.parquet(str(tmp_path / "t")).filter(p.half_open("t", datetime(2024, 7, 1, 6), datetime(2024, 7, 2)))
        assert found.count() == 18
        assert "GreaterThanOrEqual(t" in plan_text(found)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_containment_of_objects_nulls_and_large_numbers(spark):
    from driftline.functions.predicates import json_contains

    rows = [('{"a": {}}',), ('{"b": 1}',), (None,), ('{"n": 9007199254740993}',), ('{"n": 9007199254740992}',), ("[1]",), ('{"n": 1.0}',)]
    df = spark.createDataFrame(rows, "d string").coalesce(1)

    def hits(pattern):
        return [r[0] for r in df.select(json_contains("d", pattern)).collect()]

    assert hits({"a": {}}) == [True, False, False, False, False, False, False]
    assert hits({}) == [True, True, False, True, True, False, True]
    assert hits({"n": 9007199254740993}) == [False, False, False, True, False, False, False]
    assert hits({"n": 1}) == [False] * 6 + [True]
