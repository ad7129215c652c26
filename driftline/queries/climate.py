"""Climate queries over the order tables, which stand in for dated observations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import climate as ops
from driftline.operators.relational import first_per_key
from driftline.queries.registry import query, table
from driftline.schemas import MONTH_NAMES


def priced_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose price is a decimal measure, so that means do not depend on the order of addition."""
    return table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,4)"))


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS avg_value
    FROM lineitem
    WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2000-01-01'
    GROUP BY 1
    """
)
def yearly_avg_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    return ops.yearly_mean_between(rows, "l_shipdate", "l_quantity", date(1996, 1, 1), date(1999, 12, 31))


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(o_totalprice) AS avg_value
    FROM orders GROUP BY 1
    """
)
def yearly_avg(spark: SparkSession, sf: str) -> DataFrame:
    return ops.yearly_mean(priced_orders(spark, sf), "o_orderdate", "o_totalprice")


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / count(l_extendedprice) AS avg_value
    FROM lineitem GROUP BY 1
    """
)
def yearly_avg_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of a decimal measure: summed exactly, divided once."""
    rows = table(spark, sf, "lineitem").select("l_shipdate", F.col("l_extendedprice").cast("decimal(18,4)").alias("value"))
    return ops.yearly_mean(rows, "l_shipdate", "value")


@query(
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(o_totalprice) AS avg_value
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
    """
)
def monthly_avg_category(spark: SparkSession, sf: str) -> DataFrame:
    return ops.monthly_mean(priced_orders(spark, sf), "o_orderdate", "o_totalprice", "o_orderstatus", "F")


@query(
    """
    SELECT min(l_shipdate) AS earliest_date, max(l_shipdate) AS latest_date, count(*) AS row_count FROM lineitem
    """
)
def date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return ops.date_bounds(table(spark, sf, "lineitem"), "l_shipdate")


@query("SELECT count(*) AS row_count FROM lineitem")
def global_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT count(*) AS total_records,
           count(*) FILTER (WHERE l_orderkey IS NULL) AS null_l_orderkey,
           count(*) FILTER (WHERE l_shipdate IS NULL) AS null_l_shipdate,
           count(*) FILTER (WHERE l_discount = 0) AS null_discount,
           count(*) FILTER (WHERE l_tax = 0) AS null_tax
    FROM lineitem
    """
)
def null_audit(spark: SparkSession, sf: str) -> DataFrame:
    zero = F.lit(0.0)
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_shipdate",
        F.nullif("l_discount", zero).alias("discount"),
        F.nullif("l_tax", zero).alias("tax"),
    )
    return ops.null_audit(rows)


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def distinct_years(spark: SparkSession, sf: str) -> DataFrame:
    return ops.distinct_years(table(spark, sf, "orders"), "o_orderdate")


@query(
    """
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice
    FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC
    """
)
def distinct_on_latest(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    return first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], latest=True)


@query(
    """
    SELECT measure, count(*) AS row_count, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total
    FROM (
        SELECT 'l_quantity' AS measure, l_quantity AS value FROM lineitem
        UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT 'l_tax', l_tax FROM lineitem
    ) GROUP BY measure
    """
)
def wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = ops.measures_long(table(spark, sf, "lineitem"), [], measures)
    return rows.groupBy("measure").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"),
    )


@query(
    """
    WITH cells AS (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month_no,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(o_totalprice) AS mean
        FROM orders GROUP BY 1, 2
    ), grid AS (
        SELECT year, CAST(m AS INTEGER) AS month_no FROM (SELECT DISTINCT year FROM cells), range(1, 13) AS r(m)
    )
    SELECT year, month_no,
           (['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'])[month_no] AS month,
           mean AS temperature_anomaly
    FROM grid LEFT JOIN cells USING (year, month_no)
    """
)
def anomaly_long(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly rows with twelve month columns, months without data NULL, turned to twelve rows each."""
    means = [
        F.expr(
            f"try_divide(CAST(sum(o_totalprice) FILTER (WHERE month = {number}) AS DOUBLE), "
            f"count(o_totalprice) FILTER (WHERE month = {number}))"
        ).alias(name.lower())
        for number, name in enumerate(MONTH_NAMES, start=1)
    ]
    orders = priced_orders(spark, sf).withColumn("month", F.month("o_orderdate"))
    wide = orders.groupBy(F.year("o_orderdate").alias("year")).agg(*means)
    return ops.yearly_anomaly_long(wide)


@query(
    """
    WITH parts AS (
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) + 3 AS d, o_totalprice FROM orders
    )
    SELECT TRY_CAST(y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS date,
           count(*) AS row_count, CAST(max(CAST(o_totalprice AS DECIMAL(10,4))) AS DOUBLE) AS max_extent
    FROM parts GROUP BY 1
    """
)
def date_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Dates built from parts; days past the end of a month give NULL."""
    extents = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        (F.day("o_orderdate") + 3).alias("day"),
        F.col("o_totalprice").cast("decimal(10,4)").alias("extent"),
        F.lit(0).cast("decimal(10,4)").alias("missing"),
        F.col("o_orderpriority").alias("source_data"),
    )
    by_date = ops.sea_ice_by_date(extents)
    return by_date.groupBy("date").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("extent").cast("double").alias("max_extent")
    )
