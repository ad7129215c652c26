"""Reader and writer round trips: data of the given tables written out, read back and compared.

Files go to the shared folder the session names; each run takes a fresh path.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators import climate
from driftline.plans import layout
from driftline.plans.star_catalogue import load_star_files, read_star_table
from driftline.plans.stations import load_stations, read_station_table
from driftline.plans.tracked_load import TrackedLoad
from driftline.plans.wide_tables import export_text
from driftline.queries.registry import query, table
from driftline.session import work_path
from driftline.sources import delimited, fixed_width, listing, shredded, sinks
from driftline.sources.rejects import REASON, over_limit, reject_rate, split_rejects

# --- fixed width ---------------------------------------------------------------


def _month_lines(orders: DataFrame) -> DataFrame:
    """Orders as fixed-width month lines: customer is the station, status the element."""
    missing = fixed_width.MISSING_READING
    days = [
        F.expr(f"lpad(coalesce(max(CASE WHEN d = {d} THEN reading END), {missing}), 5, ' ') || 'M Q'").alias(f"d{d}")
        for d in range(1, 32)
    ]
    readings = orders.selectExpr(
        "format_string('C%010d%04d%02d%-4s', o_custkey, year(o_orderdate), month(o_orderdate), o_orderstatus) AS head",
        "day(o_orderdate) AS d",
        "CAST(floor(o_totalprice / 10) AS INT) AS reading",
    )
    months = readings.groupBy("head").agg(*days)
    return months.select(F.concat("head", *[f"d{d}" for d in range(1, 32)]).alias("value"))


@query(
    """
    WITH days AS (
        SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, max(floor(o_totalprice / 10)) AS v
        FROM orders GROUP BY 1, 2, 3
    )
    SELECT printf('C%010d', o_custkey) AS station_id, o_orderstatus AS element, count(*) AS readings,
           CAST(sum(v) AS BIGINT) AS total, min(day) AS first_day, max(day) AS last_day, count(*) AS flagged, 0::BIGINT AS rejects
    FROM days GROUP BY 1, 2
    """
)
def fixed_width_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "month-lines")
    sinks.write_report(_month_lines(table(spark, sf, "orders")), path)
    parsed = fixed_width.read_daily(spark, path)
    return parsed.groupBy("station_id", "element").agg(
        F.count("value").alias("readings"),
        F.sum("value").cast("long").alias("total"),
        F.min("observation_date").alias("first_day"),
        F.max("observation_date").alias("last_day"),
        F.count_if((F.col("mflag") == "M") & F.col("qflag").isNull() & (F.col("sflag") == "Q")).alias("flagged"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejects"),
    )


def _station_lines(suppliers: DataFrame) -> DataFrame:
    """Suppliers as station lines; every region of nations without a value gets the blank or the sentinel."""
    latitude = F.format_string("%8.4f", F.col("s_acctbal") / 100)
    longitude = F.format_string("%9.4f", F.col("s_acctbal") / 100 - 50)
    low = F.col("s_nationkey") < 10
    elevation = F.when(low, F.lit("-999.9")).otherwise(F.format_string("%6.1f", F.floor("s_acctbal") / 10))
    state = F.when(low, F.lit("  ")).otherwise(F.format_string("%02d", "s_nationkey"))
    wmo = F.when(low, F.lit("     ")).otherwise(F.format_string("%05d", "s_nationkey"))
    line = F.concat_ws(
        " ",
        F.format_string("S%010d", "s_suppkey"),
        latitude,
        longitude,
        elevation,
        state,
        F.rpad("s_name", 30, " "),
        F.lit("GSN"),
        F.lit("   "),
        wmo,
    )
    return suppliers.select(line.alias("value"))


@query(
    """
    SELECT printf('S%010d', s_suppkey) AS station_id, CAST(printf('%.4f', s_acctbal / 100) AS DECIMAL(8,4)) AS latitude,
           CAST(printf('%.4f', s_acctbal / 100 - 50) AS DECIMAL(9,4)) AS longitude,
           CASE WHEN s_nationkey >= 10 THEN CAST(printf('%.1f', floor(s_acctbal) / 10) AS DECIMAL(5,1)) END AS elevation,
           CASE WHEN s_nationkey >= 10 THEN printf('%02d', s_nationkey) END AS state, s_name AS station_name,
           'GSN' AS gsn_flag, CAST(NULL AS VARCHAR) AS hcn_crn_flag,
           CASE WHEN s_nationkey >= 10 THEN printf('%05d', s_nationkey) END AS wmo_id
    FROM supplier
    """
)
def station_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "station-lines")
    sinks.write_report(_station_lines(table(spark, sf, "supplier")), path)
    return split_rejects(fixed_width.read_stations(spark, path))[0].drop("source_file")


@query(
    """
    WITH t AS (
        SELECT *, CAST(CAST(printf('%.4f', s_acctbal / 100) AS DECIMAL(8,4)) AS VARCHAR) AS lat,
               CAST(CAST(printf('%.4f', s_acctbal / 100 - 50) AS DECIMAL(9,4)) AS VARCHAR) AS lon,
               CAST(CAST(printf('%.1f', floor(s_acctbal) / 10) AS DECIMAL(5,1)) AS VARCHAR) AS elev
        FROM supplier
    )
    SELECT 'Station ID: ' || printf('S%010d', s_suppkey) || ', Latitude: ' || regexp_replace(lat, '(\\.\\d+?)0+$', '\\1')
           || ', Longitude: ' || regexp_replace(lon, '(\\.\\d+?)0+$', '\\1')
           || ', Elevation: ' || CASE WHEN s_nationkey >= 10 THEN elev ELSE 'None' END
           || ', State: ' || CASE WHEN s_nationkey >= 10 THEN printf('%02d', s_nationkey) ELSE 'None' END || ', Name: '
           || s_name || ', GSN Flag: GSN, HCN/CRN Flag: None, WMO ID: '
           || CASE WHEN s_nationkey >= 10 THEN printf('%05d', s_nationkey) ELSE 'None' END AS value
    FROM t
    """
)
def station_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines with all nine fields."""
    return fixed_width.station_report(station_roundtrip(spark, sf))


@query(
    """
    SELECT count(*) AS stations, count(*) FILTER (WHERE s_nationkey < 10) AS without_elevation,
           CAST(sum(CAST(printf('%.4f', s_acctbal / 100) AS DECIMAL(8,4))) AS DOUBLE) AS latitude_sum
    FROM supplier
    """
)
def station_load(spark: SparkSession, sf: str) -> DataFrame:
    """Station files loaded twice: the second load finds every station present."""
    work = work_path(spark, "station-load")
    sinks.write_report(_station_lines(table(spark, sf, "supplier")), f"{work}/in")
    for _ in range(2):
        load_stations(spark, f"{work}/in", f"{work}/table")
    return read_station_table(spark, f"{work}/table").agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if(F.col("elevation").isNull()).alias("without_elevation"),
        F.sum("latitude").cast("double").alias("latitude_sum"),
    )


# --- delimited text ----------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_brand, p_type, nullif(p_size, 7) AS p_size, p_retailprice, p_name AS words FROM part")
def delimited_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Text format with NULL markers and array literals."""
    parts = table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", F.nullif("p_size", F.lit(7)).alias("p_size"), "p_retailprice",
        F.split("p_name", " ").alias("words"),
    )
    path = work_path(spark, "text-format")
    export_text(parts, path)
    parsed = delimited.read_text_format(spark, path, parts.schema)
    return split_rejects(parsed)[0].drop("source_file").withColumn("words", F.array_join("words", " "))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def text_format_escapes(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with line breaks, tabs and delimiters through the escaped text format."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = work_path(spark, "text-escapes")
    export_text(documents, path)
    return split_rejects(delimited.read_text_format(spark, path, documents.schema))[0].drop("source_file")


@query("SELECT p_partkey, p_name, p_brand || '|é' || chr(9) || p_type AS label FROM part")
def text_format_byte_escapes(spark: SparkSession, sf: str) -> DataFrame:
    """Text-format lines whose names are octal and whose labels are hexadecimal byte escapes, with an end mark."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", F.concat("p_brand", F.lit("|é\t"), "p_type").alias("label"))
    octal = F.expr(r"array_join(transform(sequence(1, octet_length(p_name)), i -> '\\' || lpad(conv(hex(substr(CAST(p_name AS BINARY), i, 1)), 16, 8), 3, '0')), '')")
    pairs = F.regexp_replace(F.hex(F.col("label").cast("binary")), "(..)", r"\\x$1")
    lines = parts.select(F.concat_ws("|", F.col("p_partkey").cast("string"), octal, pairs).alias("value"))
    path = work_path(spark, "byte-escapes")
    sinks.write_report(lines.union(spark.createDataFrame([("\\.",)], "value string")), path)
    return split_rejects(delimited.read_text_format(spark, path, parts.schema))[0].drop("source_file")


@query(
    """
    SELECT year(o_orderdate)::INT AS order_year, count(*) AS orders,
           sum(CASE WHEN year(o_orderdate) = 1995 THEN -CAST(o_totalprice AS DECIMAL(18, 4)) ELSE CAST(o_totalprice AS DECIMAL(18, 4)) END)::DOUBLE AS total
    FROM orders WHERE year(o_orderdate) <> 1995 OR o_orderstatus = 'F' GROUP BY 1
    """
)
def partition_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year, of which one year is loaded again with other rows; the other years stay."""
    price = F.col("o_totalprice").cast("decimal(18,4)")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", price.alias("price"), F.year("o_orderdate").alias("order_year"))
    path = work_path(spark, "yearly-orders")
    places = {"partition_by": ["order_year"], "sort_by": ["o_orderkey"]}
    sinks.replace_partitions(orders, path, **places)
    again = orders.where("order_year = 1995 and o_orderstatus = 'F'").withColumn("price", (-F.col("price")).cast("decimal(18,4)"))
    sinks.replace_partitions(again, path, **places)
    return spark.read.parquet(path).groupBy("order_year").agg(F.count("*").alias("orders"), F.sum("price").cast("double").alias("total"))


@query("SELECT coalesce(lang, 'none') AS lang, count(*) AS record_count FROM documents GROUP BY 1")
def csv_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with line breaks inside quotes, a CSV folder per language, counted without one task a file."""
    documents = table(spark, sf, "documents").select("doc_id", "text", F.coalesce("lang", F.lit("none")).alias("lang"))
    path = work_path(spark, "quoted-breaks")
    writer = documents.hint("rebalance", "lang").write.partitionBy("lang")
    writer.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    counts = delimited.count_quoted_records(spark, path)
    lang = F.url_decode(F.regexp_extract("source_file", "lang=([^/]+)/", 1))
    return counts.groupBy(lang.alias("lang")).agg(F.sum("record_count").alias("record_count"))


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) = 69")
def json_shredded_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Equality on a JSON path over a written table that keeps the path beside the variant."""
    path = work_path(spark, "shredded")
    shredded.write_shredded(table(spark, sf, "events"), path, "props", {"k": ("$.k", shredded.WHOLE)}, ["event_id"])
    found = spark.read.parquet(path).where(shredded.path_equals("props", "k", 69))
    return found.select("event_id", "user_id", F.variant_get("props", "$.k", "bigint").alias("k"))


_ORDER_FILE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_totalprice", T.DecimalType(18, 4)),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def _order_file(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*[F.col(f.name).cast(f.dataType) for f in _ORDER_FILE.fields])


@query(
    """
    SELECT o_orderpriority, count(*) AS row_count, min(CAST(o_orderdate AS DATE)) AS first_day,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "csv-scan")
    _order_file(spark, sf).write.option("header", True).csv(path)
    rows = delimited.scan_csv(spark, path, _ORDER_FILE)
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderdate").alias("first_day"),
        F.sum("o_totalprice").cast("double").alias("total"),
    )


@query(
    """
    SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'o_totalprice' WHEN '2-HIGH' THEN 'o_totalprice' WHEN '1-URGENT' THEN 'o_orderdate'
                WHEN '3-MEDIUM' THEN 'columns' END AS reject_reason, count(*) AS row_count
    FROM orders GROUP BY 1
    """
)
def csv_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """A text or a fraction that does not fit, a bare year and a further field reject the row and name the column."""
    path = work_path(spark, "csv-rejects")
    _faulty_lines(spark, sf).write.text(path)
    parsed = delimited.scan_csv_with_rejects(spark, path, _ORDER_FILE, header=False)
    return parsed.groupBy(REASON).agg(F.count(F.lit(1)).alias("row_count"))


def _faulty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV lines; each priority but one has a fault of its own kind."""
    kind = F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        F.concat_ws(
            ",",
            F.col("o_orderkey").cast("string"),
            F.when(kind == "1-URGENT", F.year(day).cast("string")).otherwise(day.cast("string")),
            F.when(kind == "5-LOW", F.lit("n/a")).when(kind == "2-HIGH", F.concat(price, F.lit("12345"))).otherwise(price),
            F.when(kind == "3-MEDIUM", F.lit("x,y")).otherwise(kind),
        ).alias("value")
    )


@query(
    """
    SELECT o_orderpriority AS part, sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END)::BIGINT AS loaded_rows,
           o_orderpriority <> '4-NOT SPECIFIED' AS refused
    FROM orders GROUP BY 1
    """
)
def csv_reject_limit(spark: SparkSession, sf: str) -> DataFrame:
    """A load per priority under the limit of 1 percent: those with faults in every row are refused."""
    path = work_path(spark, "csv-limit")
    lines = _faulty_lines(spark, sf)
    priorities = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderpriority").alias("part"))
    lines = lines.select("value", F.substring_index("value", ",", 1).alias("k")).join(priorities, "k").select("value", "part")
    lines.write.partitionBy("part").text(path)
    parsed = delimited.scan_csv_with_rejects(spark, f"{path}/*", _ORDER_FILE, header=False)
    part = F.url_decode(F.regexp_extract("source_file", "part=([^/]+)/", 1))
    rates = reject_rate(parsed.withColumn("part", part), by="part").withColumn("refused", over_limit(1.0))
    loaded = F.when(F.col("refused"), F.lit(0)).otherwise(F.col("total_rows") - F.col("rejected_rows")).cast("long")
    return rates.select("part", loaded.alias("loaded_rows"), "refused")


#: Rows of each file of ``csv_after_preamble``, which are sorted together; there are three files at least.
_PREAMBLE_FILE_ROWS = 200_000


@query(
    """
    SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS row_count,
           count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS missing_prices
    FROM orders GROUP BY 1
    """
)
def csv_after_preamble(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files whose title and header lines are dropped by position, with a custom null marker."""
    path = work_path(spark, "csv-preamble")
    price = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice").cast("string")).otherwise(F.lit("***"))
    data = _order_file(spark, sf).select(F.concat_ws(",", "o_orderkey", "o_orderdate", price, "o_orderpriority").alias("value"))
    files = max(3, table(spark, sf, "orders").count() // _PREAMBLE_FILE_ROWS)
    # Each file begins with its title and its header: they sort before the rows of their partition.
    title = data.sparkSession.createDataFrame([(0, "Orders of all years"), (1, ",".join(_ORDER_FILE.fieldNames()))], "n int, value string")
    rows = data.select(F.lit(2).alias("n"), "value", F.pmod(F.hash("value"), F.lit(files)).alias("file"))
    heads = title.select("n", "value", F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file"))
    rows.union(heads).repartition(files, "file").sortWithinPartitions("file", "n").select("value", "file").write.partitionBy("file").text(path)
    rows = delimited.scan_csv_after_preamble(spark, f"{path}/*", _ORDER_FILE, skip_lines=2, null="***")
    return rows.groupBy(F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_totalprice").isNull()).alias("missing_prices")
    )


@query(
    """
    SELECT o_orderpriority AS source, count(*) AS record_count FROM orders GROUP BY 1
    """
)
def csv_per_source(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV folder per source, then records per file without the header, added up per source."""
    path = work_path(spark, "csv-per-source")
    rows = _order_file(spark, sf).withColumnRenamed("o_orderpriority", "source_file")
    sinks.write_csv_per_source(rows, path)
    counts = delimited.count_records(spark, path)
    source = F.url_decode(F.regexp_extract("source_file", "source_file=([^/]+)/", 1))
    return counts.groupBy(source.alias("source")).agg(F.sum("record_count").alias("record_count"))


@query(
    """
    SELECT o_orderpriority, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
           (SELECT count(*) FROM orders) AS loaded_rows, 0::BIGINT AS failed_files
    FROM orders GROUP BY 1
    """
)
def compressed_csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """Gzip CSV files loaded with per-file isolation into a clustered table."""
    work = work_path(spark, "gz-load")
    _order_file(spark, sf).write.option("header", True).option("compression", "gzip").csv(f"{work}/in")
    report = load_star_files(spark, f"{work}/in", f"{work}/table", _ORDER_FILE, "o_orderkey")
    loaded = report.agg(F.sum("loaded_rows").alias("n"), F.count("error").alias("bad"))
    rows = read_star_table(spark, f"{work}/table", _ORDER_FILE)
    return (
        rows.groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
        .withColumn("loaded_rows", loaded.select("n").scalar())
        .withColumn("failed_files", loaded.select("bad").scalar())
    )


# --- tables -------------------------------------------------------------------------


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as daily observations: the part's nation-sized group of suppliers is the station."""
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (
        table(spark, sf, "lineitem")
        .join(suppliers, "l_suppkey")
        .select(
            F.format_string("ST%09d", "s_nationkey").alias("station_id"),
            F.col("l_shipdate").cast("date").alias("observation_date"),
            F.col("l_returnflag").alias("element"),
            F.col("l_quantity").cast("decimal(18,4)").alias("value"),
            F.lit("M").alias("mflag"),
            F.lit(None).cast("string").alias("qflag"),
            F.col("l_linestatus").alias("sflag"),
        )
    )


_DISTINCT_OBSERVATIONS_SQL = """
    SELECT DISTINCT s_nationkey, CAST(l_shipdate AS DATE) AS day, l_returnflag, l_quantity, l_linestatus
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
"""


def _started_load(spark: SparkSession, sf: str, work: str) -> TrackedLoad:
    """Observation files in a folder per station, registered as pending."""
    placed = _observations(spark, sf).withColumn("station", F.col("station_id"))
    sinks.write_csv_per_source(placed, f"{work}/in", "station")
    job = TrackedLoad(spark, f"{work}/table", lambda path: F.regexp_extract(path, "station=([^/]+)/", 1))
    job.initialise(listing.list_files(spark, f"{work}/in", "*.csv"))
    return job


def _unfinished(job: TrackedLoad) -> DataFrame:
    return job.state().agg(
        F.count_if(F.col("status") == "PENDING").alias("pending"), F.count_if(F.col("status") == "FAILED").alias("failed")
    )


@query(
    f"""
    SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS row_count, avg(l_quantity) AS avg_value,
           0::BIGINT AS pending_files, 0::BIGINT AS failed_files
    FROM ({_DISTINCT_OBSERVATIONS_SQL}) GROUP BY 1
    """
)
def tracked_load(spark: SparkSession, sf: str) -> DataFrame:
    """Files registered, claimed, loaded without duplicates, reconciled and queried."""
    job = _started_load(spark, sf, work_path(spark, "tracked-load"))
    job.load_all(batch_size=1000)
    # A station's lines may lie in several files, and duplicates are removed per file.
    state, facts = _unfinished(job), job.facts().distinct()
    return (
        facts.groupBy(F.year("observation_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("row_count"), climate.mean_of(facts, "value").alias("avg_value"))
        .withColumn("pending_files", state.select("pending").scalar())
        .withColumn("failed_files", state.select("failed").scalar())
    )


@query(
    """
    SELECT 2 * count(*) AS total_rows, TRUE AS all_files_done, 0::BIGINT AS pending_files FROM lineitem
    """
)
def tracked_batch_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Batch load, reset, batch load again: every line is appended twice."""
    job = _started_load(spark, sf, work_path(spark, "batch-load"))
    registered = job.state().count()
    job.load_batch(1000)
    job.reset()
    job.load_batch(1000)
    return (
        job.statistics()
        .withColumn("all_files_done", F.col("files_processed") == registered)
        .withColumn("pending_files", _unfinished(job).select("pending").scalar())
        .select("total_rows", "all_files_done", "pending_files")
    )


@query(
    """
    SELECT printf('ST%09d', s_nationkey) AS station_id, count(*) AS row_count, 0::BIGINT AS mismatches
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey
    """
)
def tracked_station_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Two claims, reconciled from the log's station counts; the second reads no facts of the first."""
    job = _started_load(spark, sf, work_path(spark, "station-counts"))
    job.load_batch(10)
    job.load_batch(1000)
    # The last file of a station sees all its rows.
    state = job.state().withColumn("station_id", job.station_of(F.col("file_name"))).groupBy("station_id").agg(F.max("inserted_row_count").alias("seen"))
    counts = job.station_rows().join(state, "station_id")
    return counts.select("station_id", "row_count", F.when(F.col("seen") == F.col("row_count"), 0).otherwise(1).cast("long").alias("mismatches"))


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS avg_value FROM lineitem
    WHERE l_shipdate >= DATE '1996-03-01' AND l_shipdate < DATE '1999-02-01' GROUP BY 1
    """
)
def pruned_year_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Year-partitioned table written, then read through the partition filter of a date range."""
    path = work_path(spark, "year-table")
    layout.write_daily(_observations(spark, sf), path)
    wanted = layout.prune_years(spark.read.parquet(path), "observation_date", date(1996, 3, 1), date(1999, 1, 31))
    return climate.yearly_mean(wanted, "observation_date", "value")


@query(
    """
    SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS row_count FROM orders
    WHERE o_orderdate >= DATE '1997-02-10' AND o_orderdate < DATE '1997-06-06' GROUP BY 1
    """
)
def pruned_month_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All orders routed by month; those outside the table's year are split off, the rest is read by a date range."""
    path = work_path(spark, "month-table")
    inside, _ = split_rejects(layout.mark_month_range(table(spark, sf, "orders"), "o_orderdate", 1997))
    layout.write_months(inside, path, "o_orderdate", ["o_orderdate"], 1997)
    wanted = layout.prune_months(spark.read.parquet(path), "o_orderdate", date(1997, 2, 10), date(1997, 6, 5))
    return wanted.groupBy(F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT 2 * count(*) AS appended_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows FROM
        (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    """
)
def append_select(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-select with projection and DISTINCT, run twice into one table."""
    path = work_path(spark, "append")
    for _ in range(2):
        sinks.append_rows(path, table(spark, sf, "lineitem"), columns=["l_orderkey", "l_linenumber"], distinct=True)
    stored = spark.read.parquet(path)
    return stored.agg(
        F.count(F.lit(1)).alias("appended_rows"),
        F.count_distinct("l_orderkey", "l_linenumber").alias("distinct_rows"),
    )


@query(
    """
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_quantity) AS avg_value
    FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1
    """
)
def materialized_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly mean of one category kept as a table."""
    rows = table(spark, sf, "lineitem")
    result = sinks.MaterializedResult(
        spark,
        work_path(spark, "monthly"),
        lambda: climate.monthly_mean(rows, "l_shipdate", "l_quantity", "l_returnflag", "A"),
    )
    return result.refresh().read()


@query(
    """
    SELECT count(*) AS row_count, TRUE AS sizes_add_up, CAST(count(DISTINCT year(l_shipdate)) AS INTEGER) AS partitions
    FROM lineitem
    """
)
def partition_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes per year partition from the listing against the listing of the whole table."""
    from driftline.operators.distribution import partition_sizes as sizes

    path = work_path(spark, "sizes")
    layout.write_daily(_observations(spark, sf), path)
    by_partition = sizes(spark, path, layout.YEAR_COLUMN)
    total = listing.list_files(spark, path, "*.parquet").agg(F.sum("file_size").alias("n"))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    return by_partition.agg(
        (F.sum("size_bytes") == total.scalar()).alias("sizes_add_up"),
        F.count(F.lit(1)).cast("int").alias("partitions"),
    ).select(rows.scalar().alias("row_count"), "sizes_add_up", "partitions")


@query(
    """
    SELECT l_partkey, count(*) AS row_count, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
    WHERE l_partkey BETWEEN 100 AND 140 GROUP BY 1
    """
)
def range_clustered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Key-range lookup on a table whose files hold disjoint, sorted key ranges."""
    path = work_path(spark, "clustered")
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    sinks.write_columnar(rows, path, cluster_by=["l_partkey"], sort_by=["l_partkey", "l_orderkey"], by_range=True)
    found = spark.read.parquet(path).filter(F.col("l_partkey").between(100, 140))
    return found.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").alias("quantity")
    )
