from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from driftline.streaming import ingest, monthly, stateful


def test_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = spark.createDataFrame([], "k int, v string").schema
    paths = [str(tmp_path / p) for p in ("facts", "events", "checkpoint")]

    def run():
        stream = ingest.file_stream(spark, str(folder), schema, header=True, files_per_batch=2, pattern="*.csv")
        ingest.ingest(stream, *paths).awaitTermination()

    for n in range(5):
        (folder / f"{n}.csv").write_text(f"k,v\n{n},a\n{n},b\n")
    run()
    assert ingest.read_ingested(spark, paths[0], schema).count() == 10
    assert spark.read.parquet(paths[1]).count() == 5
    assert spark.read.parquet(paths[1]).select("batch_id").distinct().count() == 3
    run()
    assert ingest.read_ingested(spark, paths[0], schema).count() == 10
    (folder / "9.csv").write_text("k,v\n9,z\n")
    run()
    assert ingest.read_ingested(spark, paths[0], schema).filter("k = 9").count() == 1
    assert spark.read.parquet(paths[1]).groupBy("file_name").count().filter("count > 1").isEmpty()


def test_monthly_mean_counts_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "t timestamp_ntz, e string, v decimal(18,4)"
    means, checkpoint = str(tmp_path / "means"), str(tmp_path / "checkpoint")

    def run(*rows):
        rows = [(t, e, Decimal(v)) for t, e, v in rows]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(folder))
        stream = ingest.file_stream(spark, str(folder), spark.createDataFrame([], schema).schema, fmt="parquet")
        monthly.maintain(stream, means, checkpoint, "t", "v", "e", "TAVG").awaitTermination()

    def found():
        return {r.month: r.avg_value for r in monthly.current_means(spark, means).collect()}

    run((datetime(2020, 1, 3), "TAVG", 1), (datetime(2020, 1, 9), "TMAX", 50))
    run((datetime(2020, 1, 20), "TAVG", 3), (datetime(2020, 2, 1), "TAVG", 7))
    run((datetime(2020, 4, 1), "TAVG", 9))
    assert found() == {date(2020, 1, 1): 2.0, date(2020, 2, 1): 7.0, date(2020, 4, 1): 9.0}
    monthly.compact(spark, means)
    run((datetime(2020, 1, 5), "TAVG", 101))  # long after later months
    want = {date(2020, 1, 1): 35.0, date(2020, 2, 1): 7.0, date(2020, 4, 1): 9.0}
    assert found() == want
    monthly.compact(spark, means)
    monthly.compact(spark, means)
    assert found() == want
    names = lambda part: sorted(p.name for p in (tmp_path / "means" / part).iterdir() if "=" in p.name)
    # Only what the compaction before the last one had folded is gone.
    assert names("partial") == ["batch_id=3"] and names("compacted") == ["through=2", "through=3"]
    run((datetime(2020, 2, 5), "TAVG", 9))
    monthly.compact(spark, means)
    assert names("partial") == ["batch_id=4"] and names("compacted") == ["through=3", "through=4"]
    assert found() == want | {date(2020, 2, 1): 8.0}


def test_bad_rows_and_refused_files(spark, tmp_path):
    from driftline.sources import delimited

    folder = tmp_path / "in"
    folder.mkdir()
    schema = spark.createDataFrame([], "k int, v decimal(6,2)").schema
    (folder / "good 1.csv").write_text("k,v\n" + "".join(f"{i},1.5\n" for i in range(200)) + "x,1.5\n")
    (folder / "bad.csv").write_text("k,v\n1,1.255\n2,2\n")
    paths = [str(tmp_path / p) for p in ("facts", "events", "checkpoint")]
    stream = delimited.stream_csv_with_rejects(spark, str(folder), schema, files_per_batch=1)
    ingest.ingest(stream, *paths, reject_percent=1.0).awaitTermination()
    events = {r.file_name.rsplit("/", 1)[1]: (r.status, r.inserted_row_count, r.error_condition) for r in spark.read.parquet(paths[1]).collect()}
    assert events == {"good 1.csv": ("COMPLETED", 200, None), "bad.csv": ("FAILED", 0, "rejected 1 of 2 rows")}
    assert ingest.read_ingested(spark, paths[0], schema).count() == 200


def test_state_is_bounded_and_late_rows_count(spark, tmp_path):
    """Equal to the batch mean after every run, with rows of any lateness; months past the watermark leave the state."""
    folder = tmp_path / "in"
    schema = "t timestamp_ntz, e string, v decimal(18,4)"
    path, checkpoint = str(tmp_path / "means"), str(tmp_path / "checkpoint")
    seen = []

    def run(*rows):
        rows = [(t, e, None if v is None else Decimal(v)) for t, e, v in rows]
        seen.extend(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = ingest.file_stream(spark, str(folder), spark.createDataFrame([], schema).schema, fmt="parquet")
        query = stateful.maintain(stream, path, checkpoint, "t", "v", "e")
        query.awaitTermination()
        means = {(r.month, r.category): r.avg_value for r in stateful.current_means(spark, path).collect()}
        groups = {}
        for t, e, v in seen:
            groups.setdefault((t and date(t.year, t.month, 1), e), []).append(v)
        values = {k: [float(v) for v in vs if v is not None] for k, vs in groups.items()}
        assert means == {k: sum(vs) / len(vs) if vs else None for k, vs in values.items()}
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    def late():
        return {(r.month, r.category): (int(r.value_sum), r.value_count) for r in stateful.late_sums(spark, path).collect()}

    run((datetime(2020, 1, 3), "a", 1), (datetime(2020, 1, 9), "b", 50), (datetime(2020, 2, 1), None, None))
    run((datetime(2020, 1, 20), "a", 3), (datetime(2020, 3, 1), "a", 7))
    assert late() == {}
    sizes = [run((datetime(2021 + n // 12, n % 12 + 1, 5), "a", n), (datetime(2021 + n // 12, n % 12 + 1, 6), "a", 1)) for n in range(5)]
    assert max(sizes) <= 5 and late() == {}
    # Late by a year, in a known and an unknown category, beside a row that is not late.
    run((datetime(2020, 1, 5), "a", 101), (datetime(2020, 1, 5), "z", 4), (datetime(2021, 5, 9), "a", 6))
    assert late() == {(date(2020, 1, 1), "a"): (101, 1), (date(2020, 1, 1), "z"): (4, 1)}
    stateful.compact(spark, path)
    run((datetime(2020, 1, 6), "a", 9), (None, "a", 2), (datetime(2021, 5, 10), "a", 5))
    stateful.compact(spark, path)
    stateful.compact(spark, path)
    assert late()[date(2020, 1, 1), "a"] == (110, 2)
    run((datetime(2021, 5, 11), "a", 8), (None, "a", 4))
    names = sorted(p.name for p in (tmp_path / "means" / "compacted").iterdir() if "=" in p.name)
    assert len(names) == 2


def test_one_task_holds_one_partition_of_the_sums(spark, tmp_path):
    """The file of a micro-batch, and a compacted one, is not made by a task that aggregates all shuffle partitions."""
    rows = spark.range(400).selectExpr("timestamp_ntz'2020-01-01' + make_interval(0, int(id % 24)) AS t", "string(id % 3) AS e", "decimal(id) AS v")
    sums = monthly.partial_sums(rows, "t", "v", "e")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = monthly.one_file(sums)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "Coalesce" not in plan and plan.index("SinglePartition") < plan.index("HashAggregate")
    schema = spark.createDataFrame([], "t timestamp_ntz, e string, v decimal(20,0)").schema
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.file_stream(spark, str(tmp_path / "in"), schema, fmt="parquet")
    stateful.maintain(stream, str(tmp_path / "means"), str(tmp_path / "checkpoint"), "t", "v", "e").awaitTermination()
    stateful.compact(spark, str(tmp_path / "means"))
    for folder in ("changes/batch_id=0", "compacted/through=0"):
        assert len(list((tmp_path / "means" / folder).glob("*.parquet"))) == 1
    assert sorted(stateful.current_means(spark, str(tmp_path / "means")).collect()) == sorted(
        sums.selectExpr("month", "category", "double(value_sum) / value_count").collect()
    )
