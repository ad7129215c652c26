"""Distinct-count sketches: building, merging and profiling HLL columns.

Sketches have 2^15 registers. Profiles turn each sketch into its estimate and
size inside the scan stage, so sketch bytes are never shuffled for a profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.scalar import epoch_text, percent, rounded_mean, value_bands
from driftline.operators.relational import expand_series

LG_REGISTERS = 15

# Cardinality bands: exclusive upper bound and label.
# Bands of estimates.
BANDS = [(1, "Empty"), (50, "Very Low (1-49)"), (100, "Low (50-99)"), (500, "Medium (100-499)")]
TOP_BAND = "High (500+)"


def build_sketches(df: DataFrame, keys: list[str], value: Column | str, name: str = "sketch") -> DataFrame:
    """One sketch of the distinct values per key; partial sketches merge across tasks."""
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(LG_REGISTERS)).alias(name))


def merge_sketches(df: DataFrame, keys: list[str], sketch: str, name: str = "sketch") -> DataFrame:
    return df.groupBy(*keys).agg(F.hll_union_agg(sketch).alias(name))


def empty_sketch(df: DataFrame) -> Column:
    """The sketch of no values, as a scalar subquery."""
    none = df.sparkSession.range(0).agg(F.hll_sketch_agg("id", F.lit(LG_REGISTERS)).alias("s"))
    return none.scalar()


def band_label(cardinality: Column | str) -> Column:
    return value_bands(cardinality, BANDS, TOP_BAND)


def set_size_sql(bucket: str, month: int) -> str:
    """Number of generated values per row by size bucket 1..10 of a month column, as SQL."""
    # Set sizes by month.
    small, medium, large, huge = 25 + 2 * month, 50 + 3 * month, 100 + 5 * month, 200 + 10 * month
    return (
        f"CASE WHEN {bucket} = 1 THEN 10 WHEN {bucket} <= 3 THEN {small} WHEN {bucket} <= 6 THEN {medium} "
        f"WHEN {bucket} <= 8 THEN {large} ELSE {huge} END"
    )


def fill_month_sketches(facts: DataFrame, timestamp: str, columns: Sequence[str], year: int = 2024) -> DataFrame:
    """Give column i the month-i sketch on all rows of month i; other rows get the empty sketch.

    Each row of the month contributes a series of values whose length depends on
    a pseudo-random bucket. All columns are filled from one expansion and one
    aggregate with a row per month. The result has at most 12 rows of at most
    2^15 register bytes each, under half a megabyte, so it is broadcast and the
    facts are not moved.
    """
    month = F.when(F.year(timestamp) == year, F.month(timestamp))
    cases = " ".join(f"WHEN {m} THEN {set_size_sql('_bucket', m)}" for m in range(1, len(columns) + 1))
    rows = (
        facts.select(timestamp, month.alias("_month"))
        .filter(F.col("_month").isNotNull())
        .select(
            "_month",
            (F.pmod(F.xxhash64(timestamp, "_month"), F.lit(10)) + 1).alias("_bucket"),
            F.concat(F.lit("_hll"), F.col("_month").cast("string"), F.lit("_"), epoch_text(timestamp), F.lit("_")).alias(
                "_tag"
            ),
        )
    )
    series = expand_series(rows.select("_month", "_tag", F.expr(f"CASE _month {cases} END").alias("_size")), F.col("_size"))
    num = F.col("num").cast("string")
    value = F.concat(num, F.col("_tag"), num)
    by_month = build_sketches(series, ["_month"], value, "_sketch")
    joined = facts.drop(*columns).withColumn("_month", month).join(F.broadcast(by_month), "_month", "left")
    blank = empty_sketch(facts)
    filled = {
        name: F.when(F.col("_month") == number, F.col("_sketch")).otherwise(blank)
        for number, name in enumerate(columns, start=1)
    }
    order = list(facts.columns) + [c for c in columns if c not in facts.columns]
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in order])


def sketch_estimates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, estimate, bytes) of every sketch, computed before anything is moved."""
    measured = df.select(
        *[
            F.struct(
                F.hll_sketch_estimate(c).alias("cardinality"), F.octet_length(c).alias("col_size")
            ).alias(c)
            for c in columns
        ]
    )
    rows = measured.unpivot([], list(columns), "hll_column", "m")
    return rows.select("hll_column", "m.cardinality", "m.col_size")


def sketch_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimate and size statistics per sketch column.

    ``sum_estimates`` adds the estimates of all rows; it is not the size of the union.
    """
    return (
        sketch_estimates(df, columns)
        .groupBy("hll_column")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("cardinality").alias("min_cardinality"),
            F.max("cardinality").alias("max_cardinality"),
            rounded_mean(F.sum("cardinality"), F.count("cardinality")).alias("avg_cardinality"),
            F.min("col_size").alias("min_size_bytes"),
            F.max("col_size").alias("max_size_bytes"),
            rounded_mean(F.sum("col_size"), F.count("col_size")).alias("avg_size_bytes"),
            F.sum("cardinality").alias("sum_estimates"),
        )
        .orderBy("hll_column")
    )


def merged_estimates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimated size of the union of all sketches per column."""
    # One partial per scan task would meet in a single task; a first step merges them in a bounded number of groups.
    groups = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(256)).alias("_group"))
    partial = groups.agg(*[F.hll_union_agg(c).alias(c) for c in columns])
    merged = partial.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    return merged.unpivot([], list(columns), "hll_column", "merged_cardinality")


def sketch_bands(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per cardinality band and their share within the column."""
    return band_shares(
        sketch_estimates(df, columns).select("hll_column", band_label("cardinality").alias("cardinality_range")),
        "hll_column",
        "cardinality_range",
    )


def band_shares(df: DataFrame, group: str, band: str) -> DataFrame:
    """Count per (group, band) and percentage within the group.

    The second step sees a handful of bands per group; it is an aggregate joined
    back on the group rather than a window, so no group is sorted in one task.
    """
    counts = df.groupBy(group, band).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(group).agg(F.sum("count").alias("_total"))
    return (
        counts.join(totals, group)
        .select(group, band, "count", percent("count", "_total").alias("percentage"))
        .orderBy(group, band)
    )
