"""Joins, key rules and set operations of the load and audit jobs.

Key sides are reduced to one row per key before any join, so a key that holds a
large part of the input shrinks in the map-side aggregate and is never gathered.
Join strategy is left to Spark: a side is broadcast only when its measured size
is below the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (IN / EXISTS)."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys`` (NOT EXISTS)."""
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def any_row(df: DataFrame) -> bool:
    """EXISTS as a driver-side boolean; stops at the first row."""
    return not df.isEmpty()


def label_join(fact: DataFrame, dim: DataFrame, on: list[str], labels: list[str]) -> DataFrame:
    """Fact rows with label columns of a dimension (inner)."""
    return fact.join(dim.select(*on, *labels), on)


def count_by_label(fact: DataFrame, dim: DataFrame, on: list[str], labels: list[str]) -> DataFrame:
    """Row counts per dimension label.

    Counting per key first means the join moves one row per key and task.
    """
    per_key = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return label_join(per_key, dim, on, labels).groupBy(*labels).agg(F.sum("_n").alias("row_count"))


def expand_series(df: DataFrame, length: Column, name: str = "num") -> DataFrame:
    """Each row repeated with 1..length; no rows for a length below one or NULL."""
    return df.select("*", F.explode(F.when(length >= 1, F.sequence(F.lit(1), length))).alias(name))


def _order_key(order_by: list[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_by)])


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str], latest: bool = False) -> DataFrame:
    """One row per key: the first (or last) in the given order.

    A min/max over ``struct(order, row)`` combines on the map side; no key is
    ever sorted or held as a group. ``order_by`` decides, remaining columns
    break ties so the choice is stable.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*order_by, *rest)
    pick = F.max(packed) if latest else F.min(packed)
    picked = df.groupBy(*keys).agg(pick.alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def update_from(target: DataFrame, source: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Target with ``columns`` overwritten where the key occurs in the source.

    A source key that occurs more than once contributes its smallest row.
    """
    staged = first_per_key(source.select(*on, *columns), on, columns).select(
        *on, F.struct(*columns).alias("_new")
    )
    joined = target.join(staged, on, "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def new_rows(target: DataFrame, candidates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Candidates to insert under "do nothing on conflict": first per key, key not in the target."""
    return keep_missing(first_per_key(candidates, keys, order_by), target, keys)


def insert_ignore(target: DataFrame, candidates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Target plus the candidates that do not conflict with it."""
    return target.unionByName(new_rows(target, candidates, keys, order_by).select(*target.columns))


def count_mismatch(expected: Column, actual: Column) -> Column:
    """Message where two counts differ (a missing count is zero), else NULL."""
    expected, actual = F.coalesce(expected, F.lit(0)), F.coalesce(actual, F.lit(0))
    message = F.format_string("Rows inserted: %d (expected %d)", actual, expected)
    return F.when(expected != actual, message)


def reconcile_counts(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """Expected against actual row counts per key, with a message where they differ.

    Both inputs carry ``row_count`` per key; a key may be missing on either side.
    """
    left = expected.select(*on, F.col("row_count").alias("expected_count"))
    right = actual.select(*on, F.col("row_count").alias("actual_count"))
    return left.join(right, on, "full_outer").withColumn(
        "error_condition", count_mismatch(F.col("expected_count"), F.col("actual_count"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once with their count; NULL keys are not compared."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def stack_rows(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def union_distinct(*frames: DataFrame) -> DataFrame:
    return stack_rows(*frames).distinct()


def top_rows(df: DataFrame, order_by: list[Column], limit: int) -> DataFrame:
    """ORDER BY ... LIMIT: each task keeps its best rows, no global sort."""
    return df.orderBy(*order_by).limit(limit)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Small relation written out in code (VALUES)."""
    return spark.createDataFrame(rows, schema)
