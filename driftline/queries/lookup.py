"""Lookups that skip data: nested sky cells, bitmaps, one table clustered for several keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import bitmaps, sky
from driftline.queries.io import _observations
from driftline.queries.registry import query, table
from driftline.queries.search import _STARS_SQL, _haversine_sql, _stars
from driftline.session import work_path
from driftline.sources import sinks


@query(
    f"""
    SELECT vec_id, round({_haversine_sql('40.0', '-35.0')}, 6) AS distance_deg FROM ({_STARS_SQL}) s
    WHERE {_haversine_sql('40.0', '-35.0')} <= 30
    """
)
def cone_search_tree(spark: SparkSession, sf: str) -> DataFrame:
    """One cone over a table written by nested cell, asked by a few ranges of ids."""
    path = work_path(spark, "star-tree")
    sky.write_by_tree_cell(_stars(spark, sf), path)
    near = sky.cone_search_tree(spark.read.parquet(path), 40.0, -35.0, 30.0)
    return near.select("vec_id", F.round("distance_deg", 6).alias("distance_deg"))


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(DISTINCT {c}) AS distinct_values, "
        f"count(DISTINCT {c})::DOUBLE / count(*) AS cardinality_ratio FROM lineitem"
        for c in _LINE_COLUMNS
    )
)
def bitmap_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distinct counts from bitmaps of the parts of a table, kept and merged."""
    path = work_path(spark, "bitmaps")
    bitmaps.value_bitmaps(table(spark, sf, "lineitem"), _LINE_COLUMNS, by=["l_returnflag"]).write.parquet(path)
    return bitmaps.bitmap_cardinality(bitmaps.merge_bitmaps(spark.read.parquet(path)))


@query(
    """
    SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem WHERE l_suppkey = 7
    """
)
def bitmap_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups that hold a value, from their bitmaps alone."""
    keys = ["l_linestatus", "l_returnflag"]
    kept = bitmaps.value_bitmaps(table(spark, sf, "lineitem"), ["l_suppkey"], by=keys)
    return bitmaps.with_value(kept, "l_suppkey", 7, keys)


_OBSERVED_SQL = """
    SELECT printf('ST%09d', s_nationkey) AS station_id, CAST(l_shipdate AS DATE) AS day, l_quantity AS value
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
"""


@query(
    f"""
    SELECT 'station and date' AS lookup, count(*) AS row_count, CAST(sum(value) AS DECIMAL(18,4)) AS total FROM ({_OBSERVED_SQL})
    WHERE station_id = 'ST000000007' AND day BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'
    UNION ALL
    SELECT 'date and value', count(*), CAST(sum(value) AS DECIMAL(18,4)) FROM ({_OBSERVED_SQL})
    WHERE day BETWEEN DATE '1997-05-01' AND DATE '1997-06-30' AND value >= 45
    """
)
def interleaved_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One table clustered by station, date and value together, looked up by two different pairs of them."""
    path = work_path(spark, "interleaved")
    sinks.write_interleaved(_observations(spark, sf), path, ["station_id", "observation_date", "value"])
    stored = spark.read.parquet(path)
    first = stored.filter((F.col("station_id") == "ST000000007") & F.col("observation_date").between(date(1996, 1, 1), date(1996, 3, 31)))
    second = stored.filter(F.col("observation_date").between(date(1997, 5, 1), date(1997, 6, 30)) & (F.col("value") >= 45))
    total = [F.count(F.lit(1)).alias("row_count"), F.sum("value").cast("decimal(18,4)").alias("total")]
    return first.agg(F.lit("station and date").alias("lookup"), *total).union(second.agg(F.lit("date and value"), *total))
