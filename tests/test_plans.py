from __future__ import annotations

import gzip
import json
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from plans import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline import schemas, session
from driftline.operators import profile
from driftline.operators.distribution import partition_sizes
from driftline.plans import layout, synth, wide_tables
from driftline.plans.star_catalogue import load_star_files, read_star_table
from driftline.plans.tracked_load import TrackedLoad
from driftline.sources import listing, sinks
from driftline.sources.rejects import REASON, RejectLimitExceeded

# --- session and layout ---------------------------------------------------------


def test_shuffle_partitions():
    assert session.shuffle_partitions_for(0, 8) == 8
    assert session.shuffle_partitions_for(100 * 1024**4, 1000) == 819200


def test_work_path_is_below_the_configured_folder(spark):
    assert session.work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def observations(spark, days):
    return spark.createDataFrame(
        [("ST000000001", d, "TMAX", Decimal(i), None, None, None) for i, d in enumerate(days)], schemas.DAILY_OBSERVATION
    )


def test_year_routing_and_pruning(spark, tmp_path):
    days = [date(1749, 12, 31), date(1750, 1, 1), date(2000, 6, 1), date(2001, 6, 1), date(2024, 12, 31), date(2025, 1, 1), None]
    path = str(tmp_path / "daily")
    layout.write_daily(observations(spark, days), path)
    table = spark.read.parquet(path)
    counts = {r.obs_part: r["count"] for r in table.groupBy("obs_part").count().collect()}
    assert counts == {"p1750": 1, "p2000": 1, "p2001": 1, "p2024": 1, "p_default": 3}
    pruned = layout.prune_years(table, "observation_date", date(2000, 1, 1), date(2000, 12, 31))
    assert pruned.count() == 1
    plan = plan_text(pruned)
    assert "PartitionFilters: [isnotnull(obs_part" in plan or "PartitionFilters: [(obs_part" in plan
    early = layout.prune_years(table, "observation_date", date(1700, 1, 1), date(1750, 1, 1))
    assert early.count() == 2
    assert layout.years_between(date(2023, 1, 1), date(2030, 1, 1)) == ["p2023", "p2024", "p_default"]
    sizes = partition_sizes(spark, path, "obs_part").collect()
    assert [r.partition_name for r in sizes] == ["p1750", "p2000", "p2001", "p2024", "p_default"]
    assert all(r.total_size.endswith("bytes") for r in sizes)


def test_hot_year_is_split_over_tasks(spark, tmp_path):
    """Most rows in one year: the rebalance write makes several files of it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(60000).select(
            F.format_string("S%010d", "id").alias("station_id"),
            F.when(F.col("id") % 10 == 0, F.lit(date(1990, 1, 1))).otherwise(F.lit(date(2000, 1, 1))).alias("observation_date"),
            F.lit("TMAX").alias("element"),
            F.col("id").cast("decimal(18,4)").alias("value"),
            *[F.lit(None).cast("string").alias(c) for c in ("mflag", "qflag", "sflag")],
        )
        path = tmp_path / "hot"
        layout.write_daily(hot, str(path))
        assert len(list((path / "obs_part=p2000").glob("*.parquet"))) > 2
        assert spark.read.parquet(str(path)).count() == 60000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def ranges_of(path, column):
    """Smallest and largest value of a column in each file."""
    import pyarrow.parquet as pq

    out = []
    for file in path.rglob("*.parquet"):
        values = pq.read_table(str(file), partitioning=None).column(column).to_pylist()
        out.append((min(values), max(values)))
    return sorted(out)


def disjoint(ranges):
    return all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_files_hold_disjoint_ranges(spark, tmp_path):
    """Daily facts by station, stars by cell, postings by token: a lookup needs few files."""
    from driftline.operators import search, sky

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        days = spark.range(40000).select(
            F.format_string("S%06d", F.pmod(F.xxhash64("id"), F.lit(9000))).alias("station_id"),
            F.lit(date(2000, 1, 1)).alias("observation_date"), F.lit("T").alias("element"), F.col("id").cast("decimal(18,4)").alias("value"),
            *[F.lit(None).cast("string").alias(c) for c in ("mflag", "qflag", "sflag")],
        )
        layout.write_daily(days, str(tmp_path / "days"))
        found = ranges_of(tmp_path / "days", "station_id")
        assert len(found) >= 4 and disjoint(found)
        assert sum(a <= "S004500" <= b for a, b in found) == 1
        stars = spark.range(40000).select((F.col("id") % 360).cast("double").alias("ra"), (F.pmod(F.xxhash64("id"), F.lit(180)) - 90.0).alias("dec"))
        sky.write_by_cell(stars, str(tmp_path / "stars"), 5.0)
        found = ranges_of(tmp_path / "stars", "cell")
        assert len(found) >= 4 and disjoint(found)
        stored = spark.read.parquet(str(tmp_path / "stars"))
        near = sky.cone_search_cells(stored, 350.0, 40.0, 12.0, 5.0)
        assert near.count() == sky.cone_search(stars, 350.0, 40.0, 12.0).count() > 0
        assert "cell" in plan_text(near).split("PushedFilters")[1]
        docs = spark.range(3000).select("id", F.concat_ws(" ", *[F.format_string("w%05d", F.pmod(F.xxhash64("id", F.lit(k)), F.lit(4000))) for k in range(9)]).alias("text"))
        search.write_token_index(search.token_postings(docs, "id", "text"), "id", str(tmp_path / "index"))
        found = ranges_of(tmp_path / "index", "token")
        assert len(found) >= 3 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_month_routing(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 2, 3),), (datetime(2024, 12, 31, 23),)], "t timestamp_ntz")
    layout.write_months(df, str(tmp_path / "m"), "t", ["t"])
    table = spark.read.parquet(str(tmp_path / "m"))
    assert {r.month_part for r in table.collect()} == {"y2024m02", "y2024m12"}
    pruned = layout.prune_months(table, "t", date(2023, 11, 1), date(2024, 2, 29))
    assert pruned.count() == 1 and "y2023m11" in plan_text(pruned)
    late = spark.createDataFrame([(datetime(2025, 1, 1),), (None,)], "t timestamp_ntz")
    with pytest.raises(Exception, match="no partition for 2025-01-01|no partition for NULL"):
        layout.route_months(late, "t").collect()
    assert [r[REASON] for r in layout.mark_month_range(late, "t").collect()] == ["range", "range"]


def test_columnar_sink(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    sinks.write_columnar(df, str(tmp_path / "r"), cluster_by=["k"], sort_by=["id"], by_range=True)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1000
    assert all(".zstd." in f.name for f in (tmp_path / "r").glob("*.parquet"))
    sinks.append_rows(str(tmp_path / "r"), df, distinct=True)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2000


# --- tracked load --------------------------------------------------------------------

HEADER = "station_id,observation_date,element,value,mflag,qflag,sflag\n"


def station_file(folder, station, rows, extra=()):
    lines = [f"{station},2000-01-{1 + i % 28:02d},TMAX,{i},,,S" for i in range(rows)] + list(extra)
    (folder / f"{station}.csv").write_text(HEADER + "\n".join(lines) + ("\n" if lines else ""))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def started(spark, inbox, tmp_path) -> TrackedLoad:
    job = TrackedLoad(spark, str(tmp_path / "table"))
    job.initialise(listing.list_files(spark, str(inbox), "*.csv"))
    return job


def state_of(job):
    return {r.file_name.rsplit("/", 1)[1]: r for r in job.state().collect()}


def test_tracked_load(spark, inbox, tmp_path):
    station_file(inbox, "A1", 10)
    station_file(inbox, "A2", 5, ["A2,2000-01-01,TMAX,0,,,S"])  # exact duplicate
    station_file(inbox, "A3", 3, ["A3,2000-02-30,TMAX,1,,,"])  # a quarter of the rows is bad
    station_file(inbox, "A4 x", 0)
    station_file(inbox, "A5", 250, ["A5,2000-01-01,TMAX,x,,,"])  # under one percent
    job = started(spark, inbox, tmp_path)
    assert {r.status for r in job.state().collect()} == {"PENDING"}
    assert job.facts().count() == 0
    assert job.load_files(2) == 2
    assert [r.file_name.rsplit("/", 1)[1] for r in job.pending(10).collect()] == ["A3.csv", "A4 x.csv", "A5.csv"]
    assert job.load_all(batch_size=10) == 3
    state = state_of(job)
    assert (state["A1.csv"].status, state["A1.csv"].csv_record_count, state["A1.csv"].error_condition) == ("COMPLETED", 10, None)
    assert state["A2.csv"].status == "COMPLETED"
    assert state["A2.csv"].error_condition == "Rows inserted: 5 (expected 6)"
    assert state["A3.csv"].status == "FAILED" and state["A3.csv"].error_condition == "rejected 1 of 4 rows"
    assert (state["A4 x.csv"].status, state["A4 x.csv"].csv_record_count) == ("COMPLETED", 0)
    assert state["A5.csv"].error_condition == "Rows inserted: 250 (expected 251)"
    assert job.facts().count() == 265
    assert job.load_files(10) == 0
    stats = job.statistics().first()
    assert (stats.files_processed, stats.total_rows) == (5, 265)
    assert stats.elapsed.count(":") == 2


def test_reset_and_reload_appends_again(spark, inbox, tmp_path):
    station_file(inbox, "A1", 4)
    job = started(spark, inbox, tmp_path)
    job.load_all()
    assert job.reset() == 1
    state = state_of(job)["A1.csv"]
    assert (state.status, state.csv_record_count, state.inserted_row_count) == ("PENDING", None, None)
    job.load_all()
    assert state_of(job)["A1.csv"].error_condition == "Rows inserted: 8 (expected 4)"
    job.initialise(listing.list_files(spark, str(inbox), "*.csv"))
    assert job.facts().count() == 8


def test_duplicates_are_removed_within_a_file_only(spark, inbox, tmp_path):
    shared = ["X,2000-01-01,TMAX,1,,,", "X,2000-01-01,TMAX,1,,,"]
    station_file(inbox, "A1", 0, shared)
    station_file(inbox, "A2", 0, shared)
    job = started(spark, inbox, tmp_path)
    job.load_files(10)
    assert job.facts().count() == 2


def test_crash_before_publishing_is_repeated_cleanly(spark, inbox, tmp_path, monkeypatch):
    station_file(inbox, "A1", 4)
    station_file(inbox, "A2", 6)
    job = started(spark, inbox, tmp_path)

    def crash(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(job, "_publish", crash)
        with pytest.raises(KeyboardInterrupt):
            job.load_files(10)
    assert job.facts().count() == 0
    job.load_files(10)
    assert job.facts().count() == 10
    assert {r.error_condition for r in job.state().collect()} == {None}


def test_missing_file_fails_alone(spark, inbox, tmp_path):
    for name in ("A1", "A2", "A3"):
        station_file(inbox, name, 2)
    job = started(spark, inbox, tmp_path)
    (inbox / "A2.csv").rename(tmp_path / "moved.csv")
    job.load_all()
    state = state_of(job)
    assert {n: r.status for n, r in state.items()} == {"A1.csv": "COMPLETED", "A2.csv": "FAILED", "A3.csv": "COMPLETED"}
    assert "A2.csv" in state["A2.csv"].error_condition
    assert job.facts().count() == 4


def test_names_with_blanks_and_percent_signs(spark, inbox, tmp_path):
    station_file(inbox, "A 1", 20)
    station_file(inbox, "B 2", 0, ["B 2,bad,TMAX,1,,,", "B 2,2000,TMAX,1,,,"])
    station_file(inbox, "100%", 3)
    station_file(inbox, "x+y", 2)
    job = started(spark, inbox, tmp_path)
    job.load_all()
    state = state_of(job)
    assert {n: (r.status, r.error_condition) for n, r in state.items()} == {
        "A 1.csv": ("COMPLETED", None), "B 2.csv": ("FAILED", "rejected 2 of 2 rows"),
        "100%.csv": ("COMPLETED", None), "x+y.csv": ("COMPLETED", None),
    }
    assert job.facts().count() == 25


def test_equal_names_in_two_stores_are_two_files(spark, tmp_path):
    job = TrackedLoad(spark, str(tmp_path / "table"))
    names = ["s3a://b1/x/a.csv", "s3a://b2/x/a.csv", "file:///x/a.csv", "file:/x/a.csv", "/x/a.csv"]
    job.initialise(spark.createDataFrame([(n,) for n in names], "file_name string"))
    assert sorted(r.file_name for r in job.state().collect()) == ["file:/x/a.csv", "s3a://b1/x/a.csv", "s3a://b2/x/a.csv"]


def jobs_of(spark, work):
    """Spark jobs that ``work`` runs."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    try:
        before = len(tracker.getJobIdsForGroup("counted"))
        work()
        return len(tracker.getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_claim_runs_few_jobs_and_log_compacts(spark, inbox, tmp_path):
    for n in range(3):
        station_file(inbox, f"A{n}", 5)
    job = started(spark, inbox, tmp_path)
    assert jobs_of(spark, lambda: job.load_files(10)) <= 20
    before = sorted(map(tuple, job.events().collect()), key=str)
    job.compact()
    assert sorted(map(tuple, job.events().collect()), key=str) == before
    assert job.log.file_count() == 1


@pytest.mark.parametrize("step", ["_before_write", "_mark", "_clear"])
def test_compaction_that_dies_loses_nothing(spark, inbox, tmp_path, monkeypatch, step):
    for n in range(3):
        station_file(inbox, f"A{n}", 5)
    job = started(spark, inbox, tmp_path)
    job.load_files(2)
    before = sorted(map(tuple, job.events().collect()), key=str)

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "_before_write":
            whole = job.log.publish
            patch.setattr(job.log, "publish", lambda write: whole(die))
        else:
            patch.setattr(job.log, step, die)
        with pytest.raises(KeyboardInterrupt):
            job.compact()
    assert sorted(map(tuple, job.events().collect()), key=str) == before
    job.load_files(10)
    job.compact()
    job.compact()
    assert {r.status for r in job.state().collect()} == {"COMPLETED"} and job.facts().count() == 15
    assert job.log.file_count() == 1 and len(list((tmp_path / "table" / "load_events").glob("v*"))) == 2


def test_a_claim_reads_no_facts_of_earlier_claims(spark, inbox, tmp_path):
    station_file(inbox, "A1", 3, ["A2,2000-01-01,TMIN,7,,,S"])
    station_file(inbox, "A2", 4)
    job = started(spark, inbox, tmp_path)
    job.load_files(1)
    assert state_of(job)["A1.csv"].error_condition == "Rows inserted: 3 (expected 4)"
    for file in (tmp_path / "table" / "facts").rglob("*.parquet"):
        file.write_bytes(b"not a table")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    job.load_files(1)
    assert state_of(job)["A2.csv"].error_condition == "Rows inserted: 5 (expected 4)"
    assert {(r.station_id, r.row_count) for r in job.station_rows().collect()} == {("A1", 3), ("A2", 5)}
    assert job.statistics().first().total_rows == 8


def test_claims_compact_a_long_log(spark, inbox, tmp_path, monkeypatch):
    monkeypatch.setattr("driftline.plans.tracked_load.COMPACT_FILES", 3)
    for n in range(5):
        station_file(inbox, f"A{n}", 2)
    job = started(spark, inbox, tmp_path)
    assert job.load_all(batch_size=1) == 5
    assert job.log.file_count() <= 4 and job.facts().count() == 10


def test_unpublished_batches_are_pruned(spark, inbox, tmp_path, monkeypatch):
    station_file(inbox, "A1", 2)
    job = started(spark, inbox, tmp_path)
    job.load_all()
    stray = tmp_path / "table" / "facts" / "batch_id=stray" / "obs_part=p2000"
    stray.mkdir(parents=True)
    (stray / "part-0.parquet").write_bytes(b"not a table")
    assert job.facts().count() == 2
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_text(job.facts())).group(1)
    assert "batch_id" in filters and "stray" not in filters


def test_materialized_result_stays_while_it_is_replaced(spark, tmp_path):
    result = sinks.MaterializedResult(spark, str(tmp_path / "m"), lambda: spark.range(3))
    held = result.refresh().read()
    result.query = lambda: spark.range(5).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        result.refresh()
    assert result.read().count() == 3
    result.query = lambda: spark.range(7)
    assert result.refresh().read().count() == 7 and held.count() == 3


def test_elapsed_time_starts_with_the_claim(spark, inbox, tmp_path):
    import time

    station_file(inbox, "A1", 1)
    job = started(spark, inbox, tmp_path)
    time.sleep(3)
    begun = time.monotonic()
    job.load_all()
    assert job.statistics().first().elapsed_seconds <= time.monotonic() - begun + 1


def test_other_errors_go_up(spark, inbox, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException

    station_file(inbox, "A1", 1)
    station_file(inbox, "A2", 1)
    job = started(spark, inbox, tmp_path)

    def refuse(*args, **kwargs):
        raise AnalysisException("disk full")

    monkeypatch.setattr("driftline.plans.tracked_load.write_daily", refuse)
    with pytest.raises(AnalysisException):
        job.load_files(10)
    assert {r.status for r in job.state().collect()} == {"PENDING"}


def test_batch_load(spark, inbox, tmp_path):
    station_file(inbox, "A1", 5, ["A1,2000-01-01,TMAX,0,,,S"])
    station_file(inbox, "A2", 5)
    job = started(spark, inbox, tmp_path)
    assert job.load_batch(10) == 2
    assert job.facts().count() == 11  # duplicates stay
    assert {r.error_condition for r in job.state().collect()} == {None}
    assert job.load_batch(10) == 0
    station_file(inbox, "A3", 1, ["A3,bad,TMAX,0,,,"])
    job.initialise(listing.list_files(spark, str(inbox), "A3.csv"))
    with pytest.raises(RejectLimitExceeded):
        job.load_batch(10)
    assert state_of(job)["A3.csv"].status == "PENDING"
    assert job.facts().count() == 11


def test_station_load_keeps_first_and_existing(spark, tmp_path):
    from driftline.plans.stations import load_stations, read_station_table

    def line(sid, lat, name):
        return f"{sid:<11} {lat:>8} {'1.0':>9} {'1.0':>6}    {name:<30}"

    path = str(tmp_path / "stations")
    assert read_station_table(spark, path).count() == 0
    (tmp_path / "a.txt").write_text("\n".join([line("A", "1.5", "first"), "", line("A", "2.5", "second"), line("B", "3.5", "b")]))
    load_stations(spark, str(tmp_path / "a.txt"), path)
    (tmp_path / "b.txt").write_text("\n".join([line("B", "9.5", "late"), line("C", "4.5", "c")]))
    load_stations(spark, str(tmp_path / "b.txt"), path)
    assert sorted((r.station_id, r.station_name) for r in read_station_table(spark, path).collect()) == [
        ("A", "first"), ("B", "b"), ("C", "c"),
    ]


# --- star catalogue -------------------------------------------------------------------

STARS = schemas._struct("source_id:long ra:double dec:double")


def test_star_files_are_isolated(spark, tmp_path):
    folder = tmp_path / "gz"
    folder.mkdir()
    for n in range(4):
        body = "source_id,ra,dec\n" + "".join(f"{n * 1000 + i},{i},{-i}\n" for i in range(50 * (n + 1)))
        (folder / f"s{n}.csv.gz").write_bytes(gzip.compress(body.encode()))
    whole = gzip.compress(("source_id,ra,dec\n" + "".join(f"{9000 + i},{i},{i}\n" for i in range(20000))).encode())
    (folder / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "badrow.csv.gz").write_bytes(gzip.compress(b"source_id,ra,dec\n1,2,3\n2,x,4\n"))
    (folder / "s 5.csv.gz").write_bytes(gzip.compress(b"source_id,ra,dec\n5001,2,3\n5002,3,4\n"))
    report = load_star_files(spark, str(folder), str(tmp_path / "t"), STARS)
    found = {r.file_name.rsplit("/", 1)[1]: (r.loaded_rows, r.error is None) for r in report.collect()}
    assert found == {
        "s0.csv.gz": (50, True), "s1.csv.gz": (100, True), "s2.csv.gz": (150, True), "s3.csv.gz": (200, True),
        "cut.csv.gz": (0, False), "badrow.csv.gz": (0, False), "s 5.csv.gz": (2, True),
    }
    assert read_star_table(spark, str(tmp_path / "t"), STARS).count() == 502
    load_star_files(spark, str(folder), str(tmp_path / "t"), STARS, pattern="s0*.csv.gz")
    assert read_star_table(spark, str(tmp_path / "t"), STARS).count() == 50
    with pytest.raises(ValueError):
        load_star_files(spark, str(tmp_path), str(tmp_path / "t2"), STARS, pattern="*.nothing")


def test_full_star_schema(spark, tmp_path):
    names = schemas.STAR_CATALOGUE.fieldNames()
    assert len(names) == 94
    values = {"designation": "star X", "phot_variable_flag": "NOT", "astrometric_primary_flag": "true", "duplicated_source": "False"}
    line = ",".join(values.get(n, "" if n in ("parallax", "radial_velocity") else "1") for n in names)
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv.gz").write_bytes(gzip.compress((",".join(names) + "\n" + line + "\n").encode()))
    assert load_star_files(spark, str(tmp_path / "x"), str(tmp_path / "y")).first().loaded_rows == 1
    row = read_star_table(spark, str(tmp_path / "y")).first()
    assert row.parallax is None and row.duplicated_source is False and row.astrometric_primary_flag is True


# --- wide tables ------------------------------------------------------------------------


def test_win_logs_roundtrip(spark, tmp_path):
    rows = synth.win_logs(spark, 200, 4, seed=1)
    assert len(rows.columns) == 227
    assert rows.exceptAll(synth.win_logs(spark, 200, 9, seed=1)).count() == 0
    wide_tables.export_text(rows, str(tmp_path / "txt"))
    wide_tables.load_win_logs(spark, str(tmp_path / "txt"), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 200 and len(table.columns) == 229
    assert table.drop("id", "month_part").select(rows.columns).exceptAll(rows).count() == 0
    checks = table.agg(
        F.min("int_col1").alias("lo"), F.max("int_col1").alias("hi"), F.max("numeric_col1").alias("n"),
        F.max(F.day("timestamp_col1")).alias("day"), F.count_if(F.col("text_col1").rlike(r"^text_0_\d+$")).alias("t"),
        F.count_if(F.col("inet_col1").rlike(r"^\d+\.\d+\.\d+\.\d+$")).alias("ip"), F.count_distinct("id").alias("ids"),
    ).first()
    assert 1 <= checks.lo < checks.hi <= 1_000_000 and checks.n <= 1000 and checks.day <= 28
    assert checks.t == checks.ip == checks.ids == 200
    found = profile.lowest_cardinality(table.drop("month_part")).collect()
    assert {r.column_name for r in found[:2]} == {"boolean_col1", "boolean_col2"} and len(found) == 10


def test_beeswax_roundtrip(spark, tmp_path):
    rows = synth.beeswax(spark, 300, 3)
    wide_tables.export_text(rows, str(tmp_path / "txt"))
    wide_tables.load_beeswax(spark, str(tmp_path / "txt"), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 300
    sample = json.loads(table.first().config_json)
    assert set(sample) == {"version", "settings"} and 1 <= len(sample["settings"]["enabled_features"]) <= 3
    assert len(set(sample["settings"]["enabled_features"])) == len(sample["settings"]["enabled_features"])
    fields = [("config_json", "version"), ("config_json", "settings.retry_count"), ("metadata_json", "environment")]
    found = {r.json_field: r.distinct_values for r in profile.json_cardinality(table, fields).collect()}
    assert found == {"config_json.version": 5, "config_json.settings.retry_count": 5, "metadata_json.environment": 3}
    shares = profile.json_frequency(table, "metadata_json", "environment").collect()
    assert abs(sum(r.percentage for r in shares) - 1) < 1e-9
    counts = profile.month_counts(table, "created_at", 2024).collect()
    assert counts[-1].row_count == 300 == sum(r.row_count for r in counts[:-1])


def test_all_facts_load(spark, tmp_path):
    rows = synth.all_facts(spark, 60, 2)
    assert len(rows.columns) == 93
    wide_tables.export_text(rows, str(tmp_path / "txt"))
    wide_tables.load_all_facts(spark, str(tmp_path / "txt"), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 60 and len(table.columns) == 106
    assert table.select(rows.columns).exceptAll(rows).count() == 0
    arrays = profile.array_profile(table, wide_tables.ARRAY_COLUMNS).collect()
    assert len(arrays) == 12 and all(1 <= r.avg_array_length <= 5 for r in arrays)


def test_bad_row_refuses_text_load(spark, tmp_path):
    rows = synth.beeswax(spark, 5, 1)
    wide_tables.export_text(rows, str(tmp_path / "txt"))
    (tmp_path / "txt" / "extra.txt").write_text("just|three|fields\n")
    with pytest.raises(Exception, match="row rejected: columns"):
        wide_tables.load_beeswax(spark, str(tmp_path / "txt"), str(tmp_path / "t"))
