"""Column, JSON, array and sketch profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.scalar import format_text_array, parse_text_array
from driftline.operators import profile, sketch
from driftline.queries.registry import query, table

_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def _cardinality_sql(name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(DISTINCT {c}) AS distinct_values, "
        f"count(DISTINCT {c})::DOUBLE / count(*) AS cardinality_ratio FROM {name}"
        for c in columns
    )


@query(_cardinality_sql("customer", _CUSTOMER_COLUMNS))
def column_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_cardinality(table(spark, sf, "customer"))


@query(_cardinality_sql("orders", ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate"]))
def chosen_column_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate"]
    return profile.column_cardinality(table(spark, sf, "orders"), columns)


@query(
    f"SELECT * FROM ({_cardinality_sql('lineitem', _LINEITEM_COLUMNS)}) ORDER BY cardinality_ratio, column_name LIMIT 10"
)
def lowest_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.lowest_cardinality(table(spark, sf, "lineitem"))


_PART_VALUES = {c: c for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")} | {"p_retailprice": "CAST(p_retailprice AS DECIMAL(18,2))"}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(coalesce(sum(strlen(CAST({v} AS VARCHAR))), 0) AS BIGINT) AS column_bytes, "
        "(SELECT CAST(" + " + ".join(f"sum(strlen(CAST({w} AS VARCHAR)))" for w in _PART_VALUES.values()) + " AS BIGINT) FROM part) "
        "AS total_bytes FROM part"
        for c, v in _PART_VALUES.items()
    )
)
def column_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of a table; the price as decimal, whose text both engines write alike."""
    part = table(spark, sf, "part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(18,2)"))
    return profile.column_sizes(part, list(_PART_VALUES))


@query(
    """
    SELECT 'props.k' AS json_field, count(*) AS total_rows, count(DISTINCT json_extract_string(props, '$.k')) AS distinct_values,
           count(DISTINCT json_extract_string(props, '$.k'))::DOUBLE / count(*) AS cardinality_ratio FROM events
    UNION ALL
    SELECT 'props.absent.key', count(*), 0, 0.0 FROM events
    """
)
def json_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.json_cardinality(table(spark, sf, "events"), [("props", "k"), ("props", "absent.key")])


@query(
    """
    SELECT 'props.k' AS column_name, json_extract_string(props, '$.k') AS value, count(*) AS frequency,
           count(*)::DOUBLE / sum(count(*)) OVER () AS percentage
    FROM events GROUP BY 2
    """
)
def json_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return profile.json_frequency(table(spark, sf, "events"), "props", "k")


@query(
    """
    SELECT 'o_orderstatus' AS column_name, nullif(o_orderstatus, 'P') AS value, count(*) AS frequency,
           count(*)::DOUBLE / sum(count(*)) OVER () AS percentage
    FROM orders GROUP BY 2
    """
)
def value_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """NULL forms its own group."""
    status = F.nullif("o_orderstatus", F.lit("P"))
    return profile.value_frequency(table(spark, sf, "orders"), status, "o_orderstatus")


def _arrays(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.split("p_name", " ").alias("name_words"), F.split("p_type", " ").alias("type_words")
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) AS total_rows, count(DISTINCT string_split({c}, ' ')) AS distinct_arrays, "
        f"CAST(avg(len(string_split({c}, ' '))) AS DECIMAL(22,2)) AS avg_array_length FROM part"
        for n, c in [("name_words", "p_name"), ("type_words", "p_type")]
    )
)
def array_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.array_profile(_arrays(spark, sf), ["name_words", "type_words"])


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) AS unique_elements, min(f) AS min_frequency, max(f) AS max_frequency, "
        f"CAST(avg(f) AS DECIMAL(22,2)) AS avg_frequency "
        f"FROM (SELECT e, count(*) AS f FROM (SELECT unnest(string_split({c}, ' ')) AS e FROM part) GROUP BY e)"
        for n, c in [("name_words", "p_name"), ("type_words", "p_type")]
    )
)
def array_element_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.array_element_stats(_arrays(spark, sf), ["name_words", "type_words"])


@query(
    r"""
    SELECT p_partkey, '{"' || replace(p_name, ' ', '","') || '","' || p_type || '"}' AS literal,
           len(string_split(p_name, ' ')) + 1 AS parsed_length, p_type AS last_element
    FROM part
    """
)
def text_array_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    items = F.concat(F.split("p_name", " "), F.array("p_type"))
    literals = table(spark, sf, "part").select("p_partkey", format_text_array(items).alias("literal"))
    parsed = literals.withColumn("items", parse_text_array("literal"))
    return parsed.select(
        "p_partkey",
        "literal",
        F.size("items").cast("long").alias("parsed_length"),
        F.element_at("items", -1).alias("last_element"),
    )


# --- sketches ------------------------------------------------------------------


@query(
    """
    SELECT event_type, count(DISTINCT user_id) AS exact, TRUE AS within_3_percent, TRUE AS merged_within_3_percent
    FROM events GROUP BY 1
    """
)
def sketch_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users per event type: exact, from one sketch, and from merged daily sketches."""
    events = table(spark, sf, "events")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    daily = sketch.build_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    merged = sketch.merge_sketches(daily, ["event_type"], "sketch", "merged")
    whole = sketch.build_sketches(events, ["event_type"], "user_id", "whole")
    close = {name: F.abs(F.hll_sketch_estimate(name) / F.col("exact") - 1) <= 0.03 for name in ("whole", "merged")}
    return (
        exact.join(whole, "event_type")
        .join(merged, "event_type")
        .select(
            "event_type",
            "exact",
            close["whole"].alias("within_3_percent"),
            close["merged"].alias("merged_within_3_percent"),
        )
    )


@query(
    """
    WITH days AS (
        SELECT event_type AS hll_column, ts::DATE AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2
    ), bands AS (
        SELECT hll_column, CASE WHEN n < 1 THEN 'Empty' WHEN n < 50 THEN 'Very Low (1-49)' WHEN n < 100 THEN 'Low (50-99)'
                                WHEN n < 500 THEN 'Medium (100-499)' ELSE 'High (500+)' END AS cardinality_range, count(*) AS "count"
        FROM days GROUP BY 1, 2
    )
    SELECT hll_column, cardinality_range, "count",
           CAST("count" * 100.0 / sum("count") OVER (PARTITION BY hll_column) AS DECIMAL(5,2)) AS percentage
    FROM bands
    """
)
def sketch_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of daily distinct users per event type."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = sketch.build_sketches(events, ["event_type", "day"], "user_id")
    banded = daily.select(
        F.col("event_type").alias("hll_column"),
        sketch.band_label(F.hll_sketch_estimate("sketch")).alias("cardinality_range"),
    )
    return sketch.band_shares(banded, "hll_column", "cardinality_range")


@query(
    """
    WITH m AS (SELECT unnest(range(1, 13)) AS month)
    SELECT 'hll_col' || month AS hll_column, (SELECT count(*) FROM orders) AS row_count,
           (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = m.month) AS filled_rows,
           TRUE AS one_value_per_month
    FROM m
    """
)
def month_sketch_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve sketch columns filled month by month, then profiled per column."""
    columns = [f"hll_col{i}" for i in range(1, 13)]
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("event_time"))
    filled = sketch.fill_month_sketches(orders, "event_time", columns, year=1998)
    measured = sketch.sketch_estimates(filled, columns)
    return measured.groupBy("hll_column").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("cardinality") > 0).alias("filled_rows"),
        (F.max("cardinality") == F.min(F.when(F.col("cardinality") > 0, F.col("cardinality")))).alias(
            "one_value_per_month"
        ),
    )


@query(
    """
    SELECT 'users' AS hll_column, TRUE AS sizes_in_bounds, count(*) AS row_count, min(n) AS min_cardinality, max(n) AS max_cardinality,
           CAST(avg(n) AS DECIMAL(22,2)) AS avg_cardinality, CAST(sum(n) AS BIGINT) AS sum_estimates
    FROM (SELECT count(DISTINCT user_id) AS n FROM events GROUP BY event_type, ts::DATE)
    """
)
def sketch_column_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of a sketch column; small sketches are exact."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = sketch.build_sketches(events, ["event_type", "day"], "user_id", "users")
    profiled = sketch.sketch_profile(daily, ["users"])
    # Bytes are the library's own; SQL can only say what they must lie between.
    low, high = F.col("min_size_bytes"), F.col("max_size_bytes")
    bounds = (low > 0) & (low <= F.col("avg_size_bytes")) & (F.col("avg_size_bytes") <= high) & (high <= 40_000)
    return profiled.withColumn("sizes_in_bounds", bounds).drop("min_size_bytes", "max_size_bytes", "avg_size_bytes")
