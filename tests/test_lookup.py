"""Nested sky cells, bitmaps and interleaved clustering."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from plans import plan_text
from pyspark.sql import functions as F

from driftline.functions import interleave, sky_tree
from driftline.operators import bitmaps, sky
from driftline.sources import sinks


def sphere(n, seed=1):
    rng = random.Random(seed)
    return [(k, rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for k in range(n)]


@pytest.fixture(scope="module")
def stars(spark):
    rows = sphere(3_000) + [(9_000 + k, float(ra), float(dec)) for k, (ra, dec) in enumerate([(0, 90), (0, -90), (45, 0), (359.999, 35.26), (135, 35.3), (0, 0), (-90, 10), (720, 10)])]
    rows += [(9_999, None, 5.0), (9_998, 5.0, None)]
    return spark.createDataFrame(rows, "id long, ra double, dec double").withColumn("cell", sky_tree.tree_cell("ra", "dec")).cache()


@pytest.mark.parametrize("cone", [(10.0, 20.0, 5.0), (0.0, 89.5, 3.0), (45.0, 35.264, 0.01), (300.0, -60.0, 40.0), (180.0, 0.0, 100.0), (0.0, 0.0, 180.0), (12.0, 3.0, 0.0)])
@pytest.mark.parametrize("most", [6, 64])
def test_ranges_hold_the_whole_cone(stars, cone, most):
    ranges = sky_tree.cone_ranges(*cone, most)
    assert 0 < len(ranges) <= most and all(a <= b < c for (a, b), (c, _) in zip(ranges, ranges[1:]))
    # Without a position there is no cell.
    inside = {r.id for r in sky.cone_search(stars.dropna(), *cone).collect()}
    met = {r.id for r in stars.filter(sky_tree.in_ranges("cell", ranges)).collect()}
    assert inside <= met
    if most == 64 and cone[2] == 40.0:
        assert len(met) < 1.3 * len(inside)


def test_cells_of_positions_are_numbered_once(stars):
    got = stars.agg(F.count("cell").alias("n"), F.min("cell").alias("low"), F.max("cell").alias("high"), F.count_distinct("cell").alias("d")).first()
    assert got.n == 3_008 and 0 <= got.low and got.high < 6 << 58 and got.d >= 3_005


def test_a_cone_is_a_filter_on_the_stored_cell(spark, stars, tmp_path):
    sky.write_by_tree_cell(stars.drop("cell"), str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    found = sky.cone_search_tree(stored, 350.0, 40.0, 12.0)
    assert {r.id for r in found.collect()} == {r.id for r in sky.cone_search(stars, 350.0, 40.0, 12.0).collect()}
    assert "Or(Or(" in plan_text(found).split("PushedFilters: ")[1]
    assert found.columns == ["id", "ra", "dec", "distance_deg"]


def test_bitmaps_count_exactly(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.choice([None, 0, 1, -1, 32_767, 32_768, 32_769, -32_768, -40_000, 2**40, rng.randrange(100_000)]), rng.choice([True, False, None])) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "part int, v long, b boolean")
    for counted in (bitmaps.value_bitmaps(df, ["v", "b"]), bitmaps.merge_bitmaps(bitmaps.value_bitmaps(df, ["v", "b"], by=["part"]))):
        got = {r.column_name: (r.total_rows, r.distinct_values) for r in bitmaps.bitmap_cardinality(counted).collect()}
        want = {name: (len(rows), len({r[k] for r in rows} - {None})) for k, name in ((1, "v"), (2, "b"))}
        assert got == want
    by_part = bitmaps.value_bitmaps(df, ["v"], by=["part"])
    for value in (0, 1, -1, 32_768, 32_769, -40_000, 2**40, rows[7][1] or 5, 99_999_999):
        assert {r.part for r in bitmaps.with_value(by_part, "v", value, ["part"]).collect()} == {r[0] for r in rows if r[1] == value}
    per_part = {r.part: r.distinct_values for r in bitmaps.bitmap_cardinality(by_part, by=["part"]).collect()}
    assert per_part == {p: len({r[1] for r in rows if r[0] == p} - {None}) for p in range(5)}
    assert bitmaps.bitmap_cardinality(bitmaps.value_bitmaps(df.limit(0))).count() == 0


def test_bitmaps_are_folded_before_the_shuffle(spark):
    plan = plan_text(bitmaps.value_bitmaps(spark.range(1000).withColumn("w", F.col("id") % 7)))
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan


def test_interleaved_keys_deal_bits_in_turn(spark):
    row = spark.range(1).select(interleave.interleaved([F.lit(0b101), F.lit(0b010)], 3).alias("k")).first()
    assert row.k == 0b100110
    with pytest.raises(ValueError):
        interleave.interleaved([F.lit(1)] * 8, 8)


def touched(folder, **wanted):
    """Files whose footers allow a row with the given closed ranges, and all files."""
    files = sorted(folder.glob("*.parquet"))
    hits = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        place = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        fits = lambda g: all(g.column(place[c]).statistics.min <= high and g.column(place[c]).statistics.max >= low for c, (low, high) in wanted.items())
        hits += any(fits(g) for g in groups)
    return hits, len(files)


def test_two_lookups_open_few_files(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"ST{rng.randrange(200):06d}", date(1990, 1, 1) + timedelta(rng.randrange(3_650)), rng.random() * 100) for _ in range(20_000)]
    rows += [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "station string, day date, value double")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sinks.write_interleaved(df, str(tmp_path / "z"), ["station", "day", "value"])
        sinks.write_columnar(df, str(tmp_path / "s"), cluster_by=["station"], sort_by=["station", "day"], by_range=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    by_station = {"station": ("ST000050", "ST000050"), "day": (date(1995, 1, 1), date(1995, 1, 31))}
    by_value = {"day": (date(1995, 1, 1), date(1995, 1, 31)), "value": (90.0, 92.0)}
    assert spark.read.parquet(str(tmp_path / "z")).count() == len(rows)
    for lookup in (by_station, by_value):
        hits, files = touched(tmp_path / "z", **lookup)
        assert files >= 40 and hits <= files / 4, (lookup, hits, files)
    hits, files = touched(tmp_path / "s", **by_value)
    assert hits >= files / 2
    assert spark.read.parquet(str(tmp_path / "z")).columns == ["station", "day", "value", "cluster_key"]


def test_cluster_key_finds_each_number_once(spark):
    """The key holds the steps of the three columns, and no list of limits is searched anew for each of its bits."""
    rows = [(f"ST{k:04d}", date(2000, 1, 1) + timedelta(k * 7 % 90), float(k * 13 % 50)) for k in range(200)] + [(None, None, None), ("ST0001", None, float("nan"))]
    df = spark.createDataFrame(rows, "station string, day date, value double")
    scale = interleave.scales(df, ["station", "day", "value"])
    keyed = interleave.with_cluster_key(df, scale, "k")
    assert keyed.columns == ["station", "day", "value", "k"]
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") == 1 and "filter(" not in plan.lower()
    numbers = df.select("station", "day", "value", *[interleave.ordinal(df, c, scale[c][0]).alias(f"n{k}") for k, c in enumerate(scale)])
    keys = {r[:3]: r.k for r in keyed.collect() if r.value == r.value}
    for r in numbers.collect():
        if r.value != r.value:
            continue
        steps = [sum(n is not None and b <= n for b in scale[c][1]) for c, n in zip(scale, r[3:], strict=True)]
        bits = [str(s >> b & 1) for b in range(interleave.BITS - 1, -1, -1) for s in steps]
        assert keys[r[:3]] == int("".join(bits), 2)
    assert keyed.where("isnan(value)").first().k & 0b001001001001001001 == interleave_last(len(scale["value"][1]))


def interleave_last(step):
    return sum((step >> b & 1) << 3 * b for b in range(interleave.BITS))
