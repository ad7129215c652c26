"""Partition routing, counts, histograms, advice and dense numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import distribution, keys, profile
from driftline.plans import layout
from driftline.queries.registry import query, table
from driftline.sources.rejects import REASON


@query(
    """
    WITH months AS (SELECT CAST(m AS INTEGER) AS m FROM range(1, 13) AS r(m)),
    parts AS (
        SELECT printf('orders_1_prt_y1996m%02d', m) AS partition_name,
               (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = months.m) AS row_count
        FROM months
    )
    SELECT * FROM parts UNION ALL SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM parts
    """
)
def partition_counts_total(spark: SparkSession, sf: str) -> DataFrame:
    return profile.month_counts(table(spark, sf, "orders"), "o_orderdate", 1996, "orders_1_prt_")


@query(
    """
    WITH named AS (
        SELECT CASE WHEN year(o_orderdate) BETWEEN 1996 AND 2005 THEN 'p' || year(o_orderdate) ELSE 'p_default' END AS name FROM orders
    ), listed AS (SELECT 'p' || y AS name FROM range(1996, 2006) t(y) UNION ALL SELECT 'p_default')
    SELECT name AS partition_name, (SELECT count(*) FROM named n WHERE n.name = l.name) AS row_count FROM listed l
    """
)
def default_partition_route(spark: SparkSession, sf: str) -> DataFrame:
    """Years without a row are listed too."""
    label = layout.year_partition("o_orderdate", 1996, 2005)
    listed = [f"p{year}" for year in range(1996, 2006)] + [layout.DEFAULT_PARTITION]
    return distribution.partition_counts(table(spark, sf, "orders"), label, expected=listed)


@query(
    """
    SELECT CASE WHEN year(o_orderdate) = 1996 THEN printf('y1996m%02d', month(o_orderdate)) END AS month_part,
           CASE WHEN year(o_orderdate) <> 1996 THEN 'range' END AS reject_reason, count(*) AS row_count
    FROM orders GROUP BY 1, 2
    """
)
def month_route_with_rejects(spark: SparkSession, sf: str) -> DataFrame:
    marked = layout.mark_month_range(table(spark, sf, "orders"), "o_orderdate", 1996)
    return marked.groupBy(layout.MONTH_COLUMN, REASON).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    p AS (SELECT CASE WHEN o_totalprice = hi THEN 21 ELSE CAST(floor((o_totalprice - lo) * 20 / (hi - lo)) AS BIGINT) + 1 END AS bucket,
                 o_totalprice FROM orders, b)
    SELECT CAST(bucket AS BIGINT) AS bucket, min(o_totalprice) AS min_value, max(o_totalprice) AS max_value, count(*) AS row_count
    FROM p GROUP BY 1
    """
)
def histogram_20(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.equal_width_histogram(table(spark, sf, "orders"), "o_totalprice")


@query(
    """
    SELECT count(*) AS total_rows, min(o_totalprice) AS min_value, max(o_totalprice) AS max_value,
           CAST(ceil(count(*) / 2000.0) AS BIGINT) AS num_partitions,
           (max(o_totalprice) - min(o_totalprice)) / ceil(count(*) / 2000.0) AS partition_width
    FROM orders
    """
)
def partition_advice(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.partition_advice(table(spark, sf, "orders"), "o_totalprice")


@query(
    """
    WITH c AS (SELECT CAST(l_orderkey % 16 AS INTEGER) AS bucket, count(*) AS row_count FROM lineitem GROUP BY 1)
    SELECT bucket, row_count, row_count::DOUBLE / (SELECT sum(row_count) FROM c)::DOUBLE * 100 AS percentage,
           row_count::DOUBLE / (SELECT avg(row_count) FROM c) AS skew_ratio
    FROM c
    """
)
def key_distribution(spark: SparkSession, sf: str) -> DataFrame:
    bucket = F.pmod("l_orderkey", F.lit(16)).cast("int")
    return distribution.bucket_counts(table(spark, sf, "lineitem"), bucket)


@query("SELECT count(*) AS row_count, 16 AS buckets, TRUE AS balanced FROM lineitem")
def hash_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Hash placement of a key with many values: all buckets used, none above twice the mean."""
    buckets = distribution.key_distribution(table(spark, sf, "lineitem"), "l_orderkey", 16)
    return buckets.agg(
        F.sum("row_count").alias("row_count"),
        F.count(F.lit(1)).cast("int").alias("buckets"),
        (F.max("skew_ratio") < 2).alias("balanced"),
    )


@query(
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders
    """
)
def dense_index(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return keys.dense_index(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index")


@query(
    """
    SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_name, s_suppkey) - 1) % 4 AS INTEGER) AS reader FROM supplier
    """
)
def round_robin_assign(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select("s_name", "s_suppkey")
    return keys.round_robin(suppliers, ["s_name", "s_suppkey"], 4).select("s_suppkey", "reader")


@query("SELECT count(*) AS row_count, count(*) AS distinct_keys FROM lineitem")
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    keyed = keys.surrogate_key(table(spark, sf, "lineitem").select("l_orderkey"))
    return keyed.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("distinct_keys"))
