from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_text

from driftline.schemas import DAILY_OBSERVATION, SEA_ICE, YEARLY_ANOMALY
from driftline.sources import delimited, fixed_width, listing, shredded, sinks
from driftline.sources.rejects import REASON, RejectLimitExceeded, enforce_reject_limit, reject_rate, split_rejects


def month_line(station: str, year: str, month: str, element: str, readings: dict[int, tuple[str, str]]) -> str:
    groups = [f"{readings.get(d, ('-9999', '   '))[0]:>5}{readings.get(d, ('', '   '))[1]:<3}" for d in range(1, 32)]
    return f"{station:<11}{year}{month}{element}" + "".join(groups)


def test_daily_lines(spark, tmp_path):
    lines = [
        month_line("ST000000001", "2020", "02", "TMAX", {1: ("-12", "BIS"), 29: ("7", ""), 30: ("9", "")}),
        month_line("ST000000001", "2021", "02", "TMIN", {}),
        month_line("ST000000002", "19x1", "01", "PRCP", {1: ("1", "")}),
        month_line("ST000000002", "1991", "01", "PRCP", {1: ("ab", ""), 2: ("5", " Q ")}),
        "ST0000000031991",
    ]
    path = tmp_path / "a.dly"
    path.write_bytes("\r\n".join(lines).encode() + b"\r\n")
    parsed = fixed_width.read_daily(spark, str(path))
    good, bad = split_rejects(parsed)
    rows = {(r.station_id, r.observation_date): r for r in good.collect()}
    assert len(rows) == 3
    first = rows["ST000000001", date(2020, 2, 1)]
    assert (first.element, first.value, first.mflag, first.qflag, first.sflag) == ("TMAX", Decimal("-12"), "B", "I", "S")
    leap = rows["ST000000001", date(2020, 2, 29)]
    assert (leap.value, leap.mflag, leap.qflag, leap.sflag) == (Decimal("7"), None, None, None)
    assert rows["ST000000002", date(1991, 1, 2)].qflag == "Q"
    assert sorted(r[REASON] for r in bad.collect()) == ["date", "line", "line", "value"]


def test_failed_file_is_dropped_whole(spark, tmp_path):
    (tmp_path / "good.dly").write_text(month_line("G", "2000", "01", "TMAX", {1: ("1", "")}) + "\n")
    (tmp_path / "bad.dly").write_text(
        month_line("B", "2000", "01", "TMAX", {1: ("1", ""), 2: ("??", "")}) + "\n"
    )
    parsed = fixed_width.read_daily(spark, str(tmp_path / "*.dly"))
    assert {r.station_id for r in split_rejects(parsed)[0].collect()} == {"G", "B"}
    assert {r.station_id for r in split_rejects(parsed, fail_file=True)[0].collect()} == {"G"}


def station_line(sid, lat, lon, elev, state="", name="", gsn="", hcn="", wmo=""):
    return f"{sid:<11} {lat:>8} {lon:>9} {elev:>6} {state:<2} {name:<30} {gsn:<3} {hcn:<3} {wmo:<5}"


def test_stations_and_report(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text(
        "\n".join(
            [
                station_line("ACW00011604", "17.1167", "-61.7833", "10.1", "", "ST JOHNS COOLIDGE FLD", "", "", ""),
                "   ",
                station_line("AE000041196", "-25.3330", "55.5170", "-999.9", "XX", "SHARJAH", "GSN", "HCN", "41196"),
                station_line("BAD00000001", "abc", "1", "1"),
            ]
        )
    )
    good, bad = split_rejects(fixed_width.read_stations(spark, str(path)))
    rows = {r.station_id: r for r in good.collect()}
    assert rows["ACW00011604"].elevation == Decimal("10.1") and rows["ACW00011604"].state is None
    assert rows["AE000041196"].elevation is None and rows["AE000041196"].latitude == Decimal("-25.3330")
    assert rows["AE000041196"].wmo_id == "41196"
    assert [r[REASON] for r in bad.collect()] == ["latitude"]
    report = sorted(r.value for r in fixed_width.station_report(good).collect())
    assert report[0].startswith("Station ID: ACW00011604, Latitude: 17.1167, Longitude: -61.7833, Elevation: 10.1, State: None")
    sinks.write_report(fixed_width.station_report(good), str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).count() == 2


def write_daily_csv(path, rows):
    header = "station_id,observation_date,element,value,mflag,qflag,sflag"
    path.write_text("\n".join([header, *rows]) + "\n")


def test_csv_scan_of_many_locations(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        write_daily_csv(tmp_path / name / f"{name}.csv", [f"{name},2020-01-01,TMAX,1.5,,,S", f"{name},2020-01-02,TMAX,2,,Q,"])
    scanned = delimited.scan_csv(spark, [str(tmp_path / "a"), str(tmp_path / "b")], DAILY_OBSERVATION)
    assert scanned.count() == 4
    assert scanned.filter("mflag IS NULL AND sflag = 'S'").count() == 2
    assert delimited.scan_csv(spark, str(tmp_path / "*" / "*.csv"), DAILY_OBSERVATION).count() == 4
    counts = delimited.count_records(spark, str(tmp_path / "*" / "*.csv")).collect()
    assert [r.record_count for r in counts] == [2, 2]


def test_quoted_line_breaks_count_once(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    (row,) = delimited.count_records(spark, str(tmp_path / "q.csv"), multi_line=True).collect()
    assert row.record_count == 2


@pytest.mark.parametrize("bad_rows,passes", [(1, True), (2, False)])
def test_reject_limit(spark, tmp_path, bad_rows, passes):
    rows = [f"S,2020-01-{1 + i % 28:02d},TMAX,{i},,," for i in range(150 - bad_rows)]
    rows += ["S,2020-13-01,TMAX,1,,,", "S,2020-01-01,TMAX,1"][:bad_rows]
    write_daily_csv(tmp_path / "x.csv", rows)
    parsed = delimited.scan_csv_with_rejects(spark, str(tmp_path / "x.csv"), DAILY_OBSERVATION)
    if passes:
        assert enforce_reject_limit(parsed, 1.0).count() == 150 - bad_rows
    else:
        reasons = {r[REASON] for r in split_rejects(parsed)[1].collect()}
        assert reasons == {"observation_date", "columns"}
        with pytest.raises(RejectLimitExceeded):
            enforce_reject_limit(parsed, 1.0)


def test_reject_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, reject_reason string")
    assert reject_rate(empty).first().reject_ratio is None
    assert enforce_reject_limit(empty).count() == 0


def test_preamble_with_null_marker(spark, tmp_path):
    header = "Year," + ",".join(f"c{i}" for i in range(18))
    for year in (1880, 2024):
        months = ["-.18"] * 6 + ["***"] * 12
        (tmp_path / f"{year}.csv").write_text(f"Land-Ocean: Global Means\n{header}\n{year},{','.join(months)}\n")
    rows = delimited.scan_csv_after_preamble(spark, str(tmp_path), YEARLY_ANOMALY, null="***").orderBy("year").collect()
    assert [r.year for r in rows] == [1880, 2024]
    assert rows[1].jan == Decimal("-0.1800") and rows[1].jul is None


def test_preamble_of_split_file(spark, tmp_path):
    """Only the first block of a file that spans many splits loses lines."""
    body = "".join(f"2000,1,{1 + i % 28},{i}.5,0,\"a, b\"\n" for i in range(4000))
    (tmp_path / "ice.csv").write_text("Year, Month\n---\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = delimited.scan_csv_after_preamble(spark, str(tmp_path), SEA_ICE)
        assert rows.rdd.getNumPartitions() > 4
        assert rows.count() == 4000
        assert rows.agg(F.sum("extent")).first()[0] == sum(Decimal(i) + Decimal("0.5") for i in range(4000))
        assert rows.filter("source_data = 'a, b'").count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_format(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, t string, arr array<string>, j string, ts timestamp_ntz, ok boolean, d double")
    (tmp_path / "t.tsv").write_text(
        "\n".join(
            [
                r'1|plain|{"x","y"}|{"k": "v"}|2024-01-02 03:04:05|true|1.5',
                r"\N|\N|\N|\N|\N|\N|\N",
                r"2||{}|\\N stays|2024-01-02|f|0",
                r'3|pipe \| and \\ and \t tab\nline|{"a\\"b","c,d",NULL,e}|q|2024-01-02|t|0',
                "4|too|few",
                "x|bad int|{}|q|2024-01-02|t|0",
            ]
        )
        + "\n"
    )
    parsed = delimited.read_text_format(spark, str(tmp_path / "t.tsv"), schema)
    good, bad = split_rejects(parsed)
    rows = {r.a: r for r in good.collect()}
    assert rows[1].arr == ["x", "y"] and rows[1].ok is True and rows[1].j == '{"k": "v"}'
    assert rows[None].t is None and rows[None].arr is None
    assert rows[2].t == "" and rows[2].arr == [] and rows[2].j == r"\N stays"
    assert rows[3].t == "pipe | and \\ and \t tab\nline"
    assert rows[3].arr == ['a"b', "c,d", None, "e"]
    assert sorted(r[REASON] for r in bad.collect()) == ["a", "columns"]


def test_text_format_roundtrip_of_long_text(spark):
    text = ("a|b\\c\n" * 20000) + '"end'
    df = spark.createDataFrame([(1, text, ["x\\y", 'q"', None])], "id int, t string, a array<string>")
    back = split_rejects(delimited.parse_text_format(delimited.format_text_lines(df), df.schema))[0].first()
    assert back.t == text and back.a == ["x\\y", 'q"', None]


def test_text_format_byte_escapes_and_end_mark(spark):
    lines = [
        r"\101\x42\x4g|\303\251|1",
        r"\\x41\\101|\N|2",
        r"\q\8\xz\|\0411|\x7c\134n|3",
        r"a\|4",
        r"\.",
        r"\..|\501|5",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = split_rejects(delimited.parse_text_format(df, T.StructType.fromDDL("t string, u string, n int")))
    rows = {r.n: (r.t, r.u) for r in good.collect()}
    assert rows == {1: ("AB\x04g", "é"), 2: (r"\x41\101", None), 3: ("q8xz|!1", r"|\n"), 5: ("..", "A")}
    assert bad.count() == 1


def test_text_format_reads_every_byte(spark):
    for form in ("\\{:03o}", "\\x{:02x}"):
        every = "".join(form.format(b) for b in range(1, 256))
        df = spark.createDataFrame([("1|" + every,)], "value string")
        parsed = delimited.parse_text_format(df, T.StructType.fromDDL("n int, t string"))
        assert bytes(split_rejects(parsed)[0].select(F.col("t").cast("binary")).first()[0]) == bytes(range(1, 256))


def test_replace_partitions_leaves_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    places = {"partition_by": ["y"], "sort_by": ["v"]}
    sinks.replace_partitions(spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 30)], "y int, v int"), path, **places)
    rows = lambda: sorted((r.y or 0, r.v) for r in spark.read.parquet(path).collect())
    sinks.replace_partitions(spark.createDataFrame([(1, 12), (3, 31)], "y int, v int"), path, **places)
    after = [(0, 30), (1, 12), (2, 20), (3, 31)]
    assert rows() == after
    broken = spark.range(200).select(F.lit(2).alias("y"), F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_partitions(broken, path, **places)
    assert rows() == after


def test_swap_table_shows_old_rows_until_the_new_are_whole(spark, tmp_path):
    root = str(tmp_path / "swapped")
    sinks.swap_table(spark.range(3).toDF("a"), "swapped_rows", root)
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("a"))
    with pytest.raises(Exception, match="lost"):
        sinks.swap_table(broken, "swapped_rows", root)
    assert spark.table("swapped_rows").count() == 3
    sinks.swap_table(spark.range(5).toDF("a"), "swapped_rows", root)
    assert spark.table("swapped_rows").count() == 5
    spark.sql("DROP VIEW swapped_rows")


def test_quoted_records_of_files_cut_inside_quotes(spark, tmp_path):
    rng = random.Random(5)
    field = lambda: '"' + "".join(rng.choice(['""', "\n", "\n\n", "word", ",", " "]) for _ in range(rng.randint(0, 12))) + '"'
    for k in range(4):
        rows = [f"{i},{field()},{field()}" for i in range(300)]
        rows.insert(7, "")
        text = "a,b,c\n" + "\n".join(rows)
        (tmp_path / f"f{k}.csv").write_text(text + ["", "\n", "\n\n", '\n1,"open\nend'][k])
    (tmp_path / "h.csv").write_text("a,b,c\n")
    plain = delimited.count_quoted_records(spark, str(tmp_path)).collect()
    wide = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        cut = delimited.count_quoted_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", wide)
    want = {"f0.csv": 300, "f1.csv": 300, "f2.csv": 300, "f3.csv": 301, "h.csv": 0}
    for got in (plain, cut):
        assert {r.source_file.rsplit("/", 1)[1]: r.record_count for r in got} == want
    one_task = delimited.count_records(spark, [str(tmp_path / f"f{k}.csv") for k in range(3)], multi_line=True).collect()
    assert sorted(r.record_count for r in one_task) == [300, 300, 300]


def test_shredded_paths_keep_their_type_and_skip_files(spark, tmp_path):
    path = str(tmp_path / "s")
    texts = ['{"k": 7, "t": "x"}', '{"k": "7", "t": 5}', '{"k": 7.0}', '{"k": 7.5, "f": true}', "no json", None, '{"k": null}', "[1]", '{"k": 1e30}']
    rows = [(i, x) for i, x in enumerate(texts)] + [(100 + i, f'{{"k": {i}}}') for i in range(100, 3000)]
    paths = {"k": ("$.k", shredded.WHOLE), "t": ("$.t", shredded.TEXT), "f": ("$.f", shredded.BOOLEAN)}
    shredded.write_shredded(spark.createDataFrame(rows, "id int, doc string").repartition(8), path, "doc", paths, ["id"])
    stored = spark.read.parquet(path)
    assert stored.count() == len(rows) and stored.where("doc is null").count() == 2
    assert sorted(r.id for r in stored.where(shredded.path_equals("doc", "k", 7)).collect()) == [0, 2]
    assert [r.id for r in stored.where(shredded.path_equals("doc", "t", "x")).collect()] == [0]
    assert [r.id for r in stored.where(shredded.path_equals("doc", "f", True)).collect()] == [3]
    wanted = stored.where(shredded.path_equals("doc", "k", 1500)).select("id")
    plan = plan_text(wanted)
    assert "EqualTo(doc__k,1500)" in plan and "variant" not in plan.split("ReadSchema")[1].split("\n")[0]
    ranges = stored.groupBy(F.col("_metadata.file_path")).agg(F.min("doc__k").alias("low"), F.max("doc__k").alias("high"))
    files = ranges.collect()
    if len(files) > 1:
        assert sum(r.low is not None and r.low <= 1500 <= r.high for r in files) == 1
    with pytest.raises(ValueError):
        shredded.typed_path("doc", "$.k", "date")


def test_file_lists(spark, tmp_path):
    (tmp_path / "list.txt").write_text("/d/a.csv\n\n  \n/d/b.csv\n")
    names = listing.file_names_from_text(spark, str(tmp_path / "list.txt")).collect()
    assert [(r.file_name, r.status) for r in names] == [("/d/a.csv", "PENDING"), ("/d/b.csv", "PENDING")]
    (tmp_path / "x.csv").write_text("1234")
    found = listing.list_files(spark, str(tmp_path), "*.csv").collect()
    assert len(found) == 1 and found[0].file_size == 4
    with pytest.raises(ValueError):
        listing.require_files(listing.list_files(spark, str(tmp_path), "*.gz"), "*.gz")


def test_without_output(spark):
    inputs = spark.createDataFrame([("/in/a.dly",), ("/in/b.dly",), ("/in/c.d.dly",)], "file_name string")
    outputs = spark.createDataFrame([("/out/a.csv",), ("/out/c.d.csv",)], "file_name string")
    assert [r.file_name for r in listing.without_output(inputs, outputs).collect()] == ["/in/b.dly"]


def test_links(spark):
    html = (
        '<!-- <a href="no1.csv.gz"> --><A class=x HREF = "one.csv.gz">1</a><a href=\'two.csv.gz\'>2</a>'
        '<a href=three.csv.gz>3</a><a href="four.txt">4</a><script>"<a href=\'no2.csv.gz\'>"</script>'
        '<a data-href="no3.csv.gz" href="five&amp;x.csv.gz">5</a>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    links = listing.extract_links(pages, "html", "https://h/")
    assert [r.href for r in links.orderBy("position").collect()] == [
        "one.csv.gz", "two.csv.gz", "three.csv.gz", "five&x.csv.gz",
    ]
    present = spark.createDataFrame([("one.csv.gz",)], "file_name string")
    assert listing.next_downloads(links, present).count() == 0
    assert {r.file_name for r in listing.next_downloads(links, present, first=3).collect()} == {"two.csv.gz", "three.csv.gz"}
    assert listing.next_downloads(links, present, first=None).count() == 3


def test_csv_per_source(spark, tmp_path):
    df = spark.createDataFrame([(i, f"f{i % 3}") for i in range(30)], "v int, source_file string")
    sinks.write_csv_per_source(df, str(tmp_path / "out"))
    for name in ("f0", "f1", "f2"):
        assert spark.read.option("header", True).csv(str(tmp_path / "out" / f"source_file={name}")).count() == 10


def test_tables(spark, tmp_path):
    df = spark.range(5)
    assert sinks.truncate_or_create(df, "t_ctl") is False
    df.write.insertInto("t_ctl")
    assert spark.table("t_ctl").count() == 5
    assert sinks.truncate_or_create(df, "t_ctl") is True
    assert spark.table("t_ctl").count() == 0
    sinks.recreate_table(df, "t_ctl")
    sinks.recreate_table(spark.range(2), "t_ctl")
    assert spark.table("t_ctl").count() == 2
    spark.sql("DROP TABLE t_ctl")
    path = str(tmp_path / "m")
    state = {"n": 3}
    result = sinks.MaterializedResult(spark, path, lambda: spark.range(state["n"])).refresh()
    state["n"] = 7
    assert result.read().count() == 3
    assert result.refresh().read().count() == 7
    assert sinks.with_load_time(df).filter("last_updated IS NOT NULL").count() == 5
    assert spark.table("v_five").count() == 5 if sinks.publish_view(df, "v_five") else False


def test_lines_of_a_large_file_meet_its_head_by_split(spark, tmp_path):
    """A file of many splits is not gathered in one task to lose its first lines."""
    (tmp_path / "a.csv").write_text("title\nhead\n" + "".join(f"{i}\n" for i in range(4000)))
    (tmp_path / "b.csv").write_text("title\n")
    settings = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = delimited.drop_leading_lines(spark.read.text(str(tmp_path)), 2)
        tasks = lines.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 4000 and len(tasks) > 1
        assert {int(r.value) for r in lines.collect()} == set(range(4000))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_preamble_files_grow_in_number(spark, tmp_path, monkeypatch):
    """More rows make more files, not larger ones, with the same counts."""
    from driftline.queries import io

    folder = tmp_path / "sf"
    orders = spark.range(5000).selectExpr(
        "id AS o_orderkey", "date_add(date'1995-01-01', int(id % 700)) AS o_orderdate", "CAST(id AS decimal(15,2)) AS o_totalprice",
        "CASE WHEN id % 5 = 0 THEN '1-URGENT' ELSE '5-LOW' END AS o_orderpriority",
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    made = []
    monkeypatch.setattr(io, "_PREAMBLE_FILE_ROWS", 250)
    monkeypatch.setattr(io, "work_path", lambda *a: made.append(str(tmp_path / "out")) or made[-1])
    rows = io.csv_after_preamble(spark, str(folder)).collect()
    assert sum(r.row_count for r in rows) == 5000 and sum(r.missing_prices for r in rows) == 1000 and len(rows) == 12
    assert len(list((tmp_path / "out").glob("file=*"))) == 20
