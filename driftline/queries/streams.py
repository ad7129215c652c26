"""Streaming jobs run to completion over the events table, and load-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.relational import first_per_key
from driftline.queries.registry import query, table
from driftline.session import work_path
from driftline.sources import delimited
from driftline.streaming import ingest, monthly, stateful


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_type <> 'error'")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events as CSV files by kind, streamed; the rows of one kind are all unreadable, so its files are refused."""
    events = table(spark, sf, "events")
    work = work_path(spark, "stream-ingest")
    value = F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise(F.lit("x"))
    lines = events.withColumn("ts", F.col("ts").cast("string")).withColumn("value", value).withColumn("kind", F.col("event_type"))
    lines.write.partitionBy("kind").option("header", True).option("escape", '"').csv(f"{work}/in")
    stream = delimited.stream_csv_with_rejects(spark, f"{work}/in/kind=*", events.schema, files_per_batch=2)
    ingest.ingest(stream, f"{work}/facts", f"{work}/events", f"{work}/checkpoint").awaitTermination()
    return ingest.read_ingested(spark, f"{work}/facts", events.schema)


_MONTHLY_MEANS = """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus AS category,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(o_totalprice) AS avg_value
    FROM orders GROUP BY 1, 2
    """


@query(_MONTHLY_MEANS)
def stream_monthly_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in several files that each span all years, one file a micro-batch."""
    work = work_path(spark, "stream-monthly")
    orders = table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,4)"))
    orders.repartition(4, F.pmod("o_orderkey", F.lit(4))).write.parquet(f"{work}/orders")
    stream = ingest.file_stream(spark, f"{work}/orders", orders.schema, fmt="parquet", files_per_batch=1)
    columns = ("o_orderdate", "o_totalprice", "o_orderstatus")
    monthly.maintain(stream, f"{work}/means", f"{work}/checkpoint", *columns).awaitTermination()
    monthly.compact(spark, f"{work}/means")
    return monthly.current_means(spark, f"{work}/means")


@query(_MONTHLY_MEANS)
def stream_monthly_mean_state(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by ranges of date, one file a micro-batch, then an eighth of all orders, most of them past the watermark."""
    work = work_path(spark, "stream-state")
    orders = table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,4)"))
    late = F.col("o_orderkey") % 8 == 0
    orders.where(~late).repartitionByRange(4, "o_orderdate").write.parquet(f"{work}/orders")
    orders.where(late).coalesce(1).write.mode("append").parquet(f"{work}/orders")
    stream = ingest.file_stream(spark, f"{work}/orders", orders.schema, fmt="parquet", files_per_batch=1)
    columns = ("o_orderdate", "o_totalprice", "o_orderstatus")
    stateful.maintain(stream, f"{work}/means", f"{work}/checkpoint", *columns).awaitTermination()
    stateful.compact(spark, f"{work}/means")
    return stateful.current_means(spark, f"{work}/means")


@query(
    """
    SELECT file_name, status, seq FROM (
        SELECT 'user_' || user_id AS file_name,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'PENDING' END AS status,
               event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
    """
)
def load_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per file of an append-only log."""
    log = _load_log(spark, sf)
    return first_per_key(log, ["file_name"], ["ts", "seq"], latest=True).select("file_name", "status", "seq")


@query(
    """
    SELECT file_name FROM (
        SELECT 'user_' || user_id AS file_name, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1 AND event_type NOT IN ('error', 'purchase') ORDER BY file_name LIMIT 20
    """
)
def claim_next(spark: SparkSession, sf: str) -> DataFrame:
    """The next pending files by name."""
    state = first_per_key(_load_log(spark, sf), ["file_name"], ["ts", "seq"], latest=True)
    return state.filter("status = 'PENDING'").orderBy("file_name").limit(20).select("file_name")


def _load_log(spark: SparkSession, sf: str) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "error", F.lit("FAILED"))
        .when(F.col("event_type") == "purchase", F.lit("COMPLETED"))
        .otherwise(F.lit("PENDING"))
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("file_name"),
        status.alias("status"),
        "ts",
        F.col("event_id").alias("seq"),
    )
