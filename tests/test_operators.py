from __future__ import annotations

import math
import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from plans import plan_text
from pyspark.sql import functions as F

from driftline.operators import climate, distribution, keys, profile, relational, search, sketch, sky


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


# --- relational ---------------------------------------------------------------


def test_first_per_key_and_insert_ignore(spark):
    cand = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), ("c", 3, "z")], "k string, o int, v string")
    assert rows(relational.first_per_key(cand, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", None), ("c", "z")]
    assert rows(relational.first_per_key(cand, ["k"], ["o"], latest=True), "k", "o") == [("a", 2), ("b", 1), ("c", 3)]
    target = spark.createDataFrame([("c", "kept")], "k string, v string")
    assert rows(relational.insert_ignore(target, cand, ["k"], ["o"])) == [("a", "y"), ("b", None), ("c", "kept")]


def test_update_from_keeps_unmatched_and_sets_null(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "A"), (1, "B"), (2, None), (9, "Z")], "k int, v string")
    assert rows(relational.update_from(target, source, ["k"], ["v"])) == [(1, "A"), (2, None), (3, "c")]


def test_reconcile(spark):
    exp = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "k string, row_count long")
    act = spark.createDataFrame([("a", 3), ("b", 1), ("d", 4)], "k string, row_count long")
    found = {r.k: r.error_condition for r in relational.reconcile_counts(exp, act, ["k"]).collect()}
    assert found == {
        "a": None,
        "b": "Rows inserted: 1 (expected 2)",
        "c": "Rows inserted: 0 (expected 1)",
        "d": "Rows inserted: 4 (expected 0)",
    }


def test_keys_and_sets(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (None, 1)], "a int, b int")
    assert rows(relational.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    assert relational.union_distinct(df, df).count() == 3
    assert relational.any_row(df) and not relational.any_row(df.filter("a = 7"))
    assert rows(relational.top_rows(df.dropna(), [F.desc("a")], 1), "a") == [(2,)]
    series = relational.expand_series(spark.createDataFrame([(0,), (1,), (3,), (None,)], "n int"), F.col("n"))
    assert rows(series) == [(1, 1), (3, 1), (3, 2), (3, 3)]


def test_semi_and_anti_joins_reduce_keys_first(spark):
    left = spark.range(10).toDF("k")
    right = spark.createDataFrame([(3,)] * 1000 + [(4,)], "k long")
    assert rows(relational.keep_matching(left, right, ["k"])) == [(3,), (4,)]
    missing = relational.keep_missing(left, right, ["k"])
    assert missing.count() == 8


def test_hot_key_is_combined_before_the_join(spark):
    """A third of all rows on one key: the join input has one row per key and task."""
    fact = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("label"))
    counted = relational.count_by_label(fact, dim, ["k"], ["label"])
    assert counted.agg(F.sum("row_count")).first()[0] == 30000
    expected = Counter((7 if i % 3 == 0 else i % 1000) % 5 for i in range(30000))
    assert dict(rows(counted)) == expected


# --- climate --------------------------------------------------------------------


def test_yearly_unpivot_keeps_missing_months(spark):
    values = {m.lower(): (float(i) if i < 3 else None) for i, m in enumerate(climate.MONTH_NAMES)}
    wide = spark.createDataFrame([(2024, *values.values())], "year int, " + ", ".join(f"{m} double" for m in values))
    long = rows(climate.yearly_anomaly_long(wide), "month_no", "month", "temperature_anomaly")
    assert len(long) == 12
    assert (1, "Jan", 0.0) in long and (12, "Dec", None) in long


def test_means_and_audit(spark):
    df = spark.createDataFrame(
        [(date(2000, 1, 5), "A", Decimal("1.0000")), (date(2000, 1, 6), "A", Decimal("2.0000")),
         (date(2001, 2, 1), "B", None), (None, "A", Decimal("4.0000"))],
        "d date, e string, v decimal(18,4)",
    )
    assert rows(climate.yearly_mean(df, "d", "v")) == [(2000, 1.5), (2001, None), (None, 4.0)]
    assert rows(climate.monthly_mean(df.dropna(subset=["d"]), "d", "v", "e", "A")) == [(date(2000, 1, 1), 1.5)]
    between = climate.yearly_mean_between(df, "d", "v", date(2000, 1, 6), date(2000, 12, 31))
    assert rows(between) == [(2000, 2.0)]
    audit = climate.null_audit(df).first()
    assert (audit.total_records, audit.null_d, audit.null_e, audit.null_v) == (4, 1, 0, 1)
    bounds = climate.date_bounds(df, "d").first()
    assert (bounds.earliest_date, bounds.latest_date, bounds.row_count) == (date(2000, 1, 5), date(2001, 2, 1), 4)
    assert [r.year for r in climate.distinct_years(df.dropna(subset=["d"]), "d").collect()] == [2000, 2001]


def test_sea_ice_dates(spark):
    df = spark.createDataFrame(
        [(1978, 1, 9, "s"), (1979, 2, 30, "t")], "year int, month int, day int, source_data string"
    ).withColumns({"extent": F.lit(1), "missing": F.lit(0)})
    assert rows(climate.sea_ice_by_date(df), "date", "source_data") == [(None, "t"), (date(1978, 1, 9), "s")]


def test_date_range_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz").alias("t"), "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_text(climate.yearly_mean_between(df, "t", "id", date(2020, 1, 1), date(2020, 6, 1)))
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


# --- profile --------------------------------------------------------------------


@pytest.fixture(scope="module")
def wide(spark):
    random.seed(5)
    data = [
        (i, random.choice(["x", "y", None]), random.choice([0.0, -0.0, 1.5, float("nan")]), i % 2 == 0,
         datetime(2024, 1, 1 + i % 7), Decimal(i % 4), [str(i % 3)] if i % 5 else [], date(2020, 1, 1 + i % 2))
        for i in range(100)
    ]
    return spark.createDataFrame(
        data, "i int, s string, d double, b boolean, t timestamp_ntz, n decimal(5,1), a array<string>, dt date"
    )


def test_cardinality_matches_count_distinct(wide):
    found = {r.column_name: r for r in profile.column_cardinality(wide).collect()}
    assert set(found) == {"i", "s", "d", "b", "t", "n", "dt"}
    for name, row in found.items():
        assert row.total_rows == 100
        assert row.distinct_values == wide.select(F.count_distinct(name)).first()[0], name
        assert row.cardinality_ratio == row.distinct_values / 100
    lowest = [r.column_name for r in profile.lowest_cardinality(wide, 3).collect()]
    assert lowest == ["b", "dt", "s"]
    approx = {r.column_name: r.distinct_values for r in profile.column_cardinality(wide, ["i", "b"], approx=True).collect()}
    assert approx["b"] == 2 and abs(approx["i"] - 100) <= 10


@pytest.mark.parametrize("approx", [False, True])
def test_cardinality_of_nothing(spark, approx):
    empty = profile.column_cardinality(spark.createDataFrame([], "a int, b string"), approx=approx)
    assert rows(empty) == [("a", 0, 0, None), ("b", 0, 0, None)]


def test_json_profiles(spark):
    docs = ['{"v": 1, "s": {"t": 5}}', '{"v": 2, "s": {"t": 5}}', '{"v": 2}', '{"v": null}', None]
    df = spark.createDataFrame([(d,) for d in docs], "c string")
    found = rows(profile.json_cardinality(df, [("c", "v"), ("c", "s.t")]), "json_field", "total_rows", "distinct_values")
    assert found == [("c.s.t", 5, 1), ("c.v", 5, 2)]
    literal = profile.json_cardinality(df, [("c", "s.t")], literal_key=True).first()
    assert literal.distinct_values == 0
    freq = rows(profile.json_frequency(df, "c", "v"), "value", "frequency", "percentage")
    assert freq == [("1", 1, 0.2), ("2", 2, 0.4), (None, 2, 0.4)]


def test_value_frequency_order(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",), ("b",)], "v string")
    assert [(r.value, r.frequency) for r in profile.value_frequency(df, "v", "v").collect()] == [("b", 2), ("a", 1), (None, 1)]


def test_array_profiles(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["x"]), (["a", "b"], None), ([], ["x", None]), (None, ["x"])], "p array<string>, q array<string>"
    )
    assert rows(profile.array_profile(df, ["p", "q"])) == [("p", 3, 2, Decimal("2.00")), ("q", 3, 2, Decimal("1.33"))]
    stats = rows(profile.array_element_stats(df, ["p", "q"]))
    assert stats == [("p", 2, 2, 2, Decimal("2.00")), ("q", 1, 1, 3, Decimal("2.00"))]


def test_sizes(spark):
    df = spark.createDataFrame([("é", 10, bytearray(b"abc")), (None, 7, None)], "s string, i int, b binary")
    assert rows(profile.column_sizes(df)) == [("b", 3, 8), ("i", 3, 8), ("s", 2, 8)]


def test_month_counts(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 31, 23),), (datetime(2024, 12, 31, 23, 59),), (datetime(2025, 1, 1),)], "t timestamp_ntz"
    )
    found = profile.month_counts(df, "t", 2024, "win_1_prt_").collect()
    assert [r.partition_name for r in found][:2] == ["win_1_prt_y2024m01", "win_1_prt_y2024m02"]
    assert (found[-1].partition_name, found[-1].row_count) == ("TOTAL", 2)
    assert len(found) == 13 and found[1].row_count == 0 and found[11].row_count == 1


# --- placement -------------------------------------------------------------------


def test_distribution(spark):
    df = spark.range(1000)
    found = distribution.key_distribution(df, "id", 8).collect()
    assert sum(r.row_count for r in found) == 1000
    assert math.isclose(sum(r.percentage for r in found), 100.0)
    assert distribution.task_distribution(df.repartition(3)).count() == 3


def test_histogram_and_advice(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "ra double")
    found = rows(distribution.equal_width_histogram(df, "ra"))
    assert [r for r in found if r[0] == 21] == [(21, 100.0, 100.0, 1)]
    assert sum(r[3] for r in found) == 102
    advice = distribution.partition_advice(spark.range(4001).select(F.col("id").cast("double").alias("ra")), "ra").first()
    assert advice.num_partitions == 3 and math.isclose(advice.partition_width, 4000 / 3)
    empty = distribution.partition_advice(spark.createDataFrame([], "ra double"), "ra").first()
    assert empty.num_partitions == 0 and empty.partition_width is None


def test_dense_index_and_round_robin(spark):
    values = random.Random(3).sample(range(10**6), 500)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    found = dict(rows(keys.dense_index(df, ["v"]), "v", "row_index"))
    assert found == {v: i for i, v in enumerate(sorted(values))}
    readers = dict(rows(keys.round_robin(df, ["v"], 3), "v", "reader"))
    assert readers == {v: i % 3 for i, v in enumerate(sorted(values))}
    keyed = keys.surrogate_key(df)
    assert keyed.columns[0] == "id" and keyed.select("id").distinct().count() == 500


# --- sketches ---------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 10, 500, 20000])
def test_sketch_estimates(spark, n):
    df = spark.range(n).select(F.lit(1).alias("g"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    merged = sketch.merge_sketches(sketch.build_sketches(df.withColumn("h", F.col("v").substr(-1, 1)), ["g", "h"], "v"), ["g"], "sketch")
    found = merged.select(F.hll_sketch_estimate("sketch")).first()
    assert (found is None and n == 0) or abs(found[0] - n) <= 0.03 * n
    if n == 0:
        assert spark.range(1).select(F.hll_sketch_estimate(sketch.empty_sketch(df))).first()[0] == 0


def test_month_fill_and_profiles(spark):
    df = spark.createDataFrame(
        [(i, datetime(2024, 1 + i % 3, 1 + i % 28, i % 24)) for i in range(60)] + [(99, datetime(2023, 1, 1))],
        "id int, event_time timestamp_ntz",
    )
    columns = [f"hll_col{i}" for i in range(1, 13)]
    filled = sketch.fill_month_sketches(df, "event_time", columns).cache()
    assert filled.count() == 61 and set(filled.columns) == {"id", "event_time", *columns}
    estimates = filled.select("id", *[F.hll_sketch_estimate(c).alias(c) for c in columns]).collect()
    for r in estimates:
        for m, c in enumerate(columns, start=1):
            assert (r[c] > 0) == (r.id != 99 and r.id % 3 + 1 == m)
    by_column = {r.hll_column: r for r in sketch.sketch_profile(filled, columns).collect()}
    january = by_column["hll_col1"]
    assert january.row_count == 61 and january.min_cardinality == 0
    assert january.sum_estimates == 20 * january.max_cardinality
    # 20 rows of one to 210 values each; equal timestamps repeat values
    assert 10 <= january.max_cardinality <= 20 * 210 * 1.03
    union = {r.hll_column: r.merged_cardinality for r in sketch.merged_estimates(filled, columns).collect()}
    assert union["hll_col1"] == january.max_cardinality and union["hll_col12"] == 0
    bands = [r for r in sketch.sketch_bands(filled, columns).collect() if r.hll_column == "hll_col1"]
    assert {r.cardinality_range: r["count"] for r in bands}["Empty"] == 41
    assert sum(r.percentage for r in bands) == Decimal("100.00")


def test_profile_does_not_shuffle_sketches(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "hll_col1 binary")
    plan = plan_text(sketch.sketch_profile(df, ["hll_col1"]))
    first_exchange = plan[plan.rindex("Exchange hashpartitioning(hll_column"):]
    assert "hll_sketch_estimate" in first_exchange


# --- sky ----------------------------------------------------------------------------


def brute_distance(ra1, dec1, ra2, dec2):
    a1, d1, a2, d2 = map(math.radians, (ra1, dec1, ra2, dec2))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((a2 - a1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h))))


@pytest.mark.parametrize("radius,cell", [(0.5, None), (7.0, None), (3.0, 10.0), (60.0, 5.0)])
def test_cone_join_equals_brute_force(spark, radius, cell):
    rnd = random.Random(11)
    points = [(i, rnd.uniform(0, 360), math.degrees(math.asin(rnd.uniform(-1, 1)))) for i in range(300)]
    points += [(1000, 359.999, 0.0), (1001, 0.001, 0.0), (1002, 12.0, 90.0), (1003, 0.0, -90.0), (1004, 200.0, 89.7)]
    centers = [(j, ra, dec) for j, (_, ra, dec) in enumerate(points[:40] + points[-5:])] + [(99, 0.0, 89.9), (98, 360.0, 0.0)]
    stars = spark.createDataFrame(points, "id int, ra double, dec double")
    cdf = spark.createDataFrame(centers, "c int, center_ra double, center_dec double")
    got = rows(sky.cone_join(stars, cdf, radius, cell), "c", "id")
    want = sorted(
        ((c, i) for c, cra, cdec in centers for i, ra, dec in points if brute_distance(ra, dec, cra, cdec) <= radius), key=repr
    )
    assert got == want
    single = rows(sky.cone_search(stars, 0.0, 0.0, radius), "id")
    assert single == sorted(((i,) for i, ra, dec in points if brute_distance(ra, dec, 0, 0) <= radius), key=repr)


# --- search ---------------------------------------------------------------------------


def test_token_search(spark, tmp_path):
    docs = [(1, "The Stars, the STARS!"), (2, "stars & planets2"), (3, None), (4, "étoile d'hiver")]
    df = spark.createDataFrame(docs, "id int, text string")
    postings = search.token_postings(df, "id", "text")
    assert rows(postings) == [("d", 4), ("hiver", 4), ("planets2", 2), ("stars", 1), ("stars", 2), ("étoile", 4)]
    assert dict(rows(search.token_document_counts(df, "text")))["stars"] == 2
    search.write_token_index(postings, "id", str(tmp_path / "ix"))
    index = spark.read.parquet(str(tmp_path / "ix"))
    assert rows(search.find_documents(index, "id", ["STARS", "the"])) == [(1,), (2,)]
    assert rows(search.find_documents(index, "id", ["stars", "planets2"])) == [(2,)]
    assert search.find_documents(index, "id", ["the"]).count() == 0
    assert rows(df.filter(search.text_matches("text", ["planets2"])), "id") == [(2,)]
    plan = plan_text(search.find_documents(index, "id", ["stars"]))
    assert "EqualTo(token,stars)" in plan or "In(token" in plan
