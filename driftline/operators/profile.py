"""Wide-table profiling: cardinality, value frequencies, arrays, JSON fields, sizes, month counts.

All profiles read the table once per value type. Rows are turned to
(column, value) pairs, counted per pair with map-side combine, and the counts are
folded per column; neither a hot value nor a hot column gathers rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.scalar import array_length, as_column, json_text, ratio, rounded_mean, wall_clock_micros

_SKIPPED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_REAL = (T.FloatType, T.DoubleType)


def profiled_columns(df: DataFrame) -> list[str]:
    """Columns with a plain value type; arrays, sketches and documents have their own profiles."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, _SKIPPED)]


def _comparable(field: T.StructField) -> tuple[str, Column]:
    """Value family of a column and the expression that keeps its values distinct within the family."""
    col, kind = F.col(field.name), field.dataType
    if isinstance(kind, _WHOLE):
        return "whole", col.cast("int").cast("long") if isinstance(kind, T.BooleanType) else col.cast("long")
    if isinstance(kind, T.DateType):
        return "whole", F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return "whole", F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        return "whole", wall_clock_micros(col)
    if isinstance(kind, _REAL):
        return "real", col.cast("double") + F.lit(0.0)
    return "text", col.cast("string")


def column_cardinality(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Rows, distinct values and their ratio per column; the ratio of an empty table is NULL.

    ``approx`` estimates the distinct count in one aggregation.
    """
    columns = list(columns or profiled_columns(df))
    families: dict[str, list[Column]] = {}
    for name in columns:
        family, value = _comparable(df.schema[name])
        families.setdefault(family, []).append(value.alias(name))
    parts = [_count_pairs(df.select(*values), approx) for values in families.values()]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return _one_row_each(counted, columns, "column_name")


def _count_pairs(values: DataFrame, approx: bool = False) -> DataFrame:
    """Row and distinct counts of same-typed columns, from one pass over (column, value) pairs.

    Columns are numbered while rows are shuffled; an integer groups faster and
    moves fewer bytes than a name. Names are put back on the folded counts.
    """
    cells = F.array(*[F.col(f"`{c}`") for c in values.columns])
    pairs = values.select(F.posexplode(cells).alias("_column", "value"))
    if approx:
        counted = pairs.groupBy("_column").agg(
            F.count(F.lit(1)).alias("total_rows"), F.approx_count_distinct("value").alias("distinct_values")
        )
    else:
        per_value = pairs.groupBy("_column", "value").agg(F.count(F.lit(1)).alias("_n"))
        counted = per_value.groupBy("_column").agg(
            F.sum("_n").alias("total_rows"), F.count("value").alias("distinct_values")
        )
    names = F.array(*[F.lit(c) for c in values.columns])
    return counted.select(F.get(names, "_column").alias("column_name"), "total_rows", "distinct_values")


def _one_row_each(counted: DataFrame, names: list[str], label: str) -> DataFrame:
    """A row per profiled column, also when the table is empty."""
    listed = counted.sparkSession.createDataFrame([(n,) for n in names], f"`{label}` string")
    # At most one row per profiled column on either side.
    joined = listed.join(F.broadcast(counted.withColumnRenamed("column_name", label)), label, "left")
    return joined.select(
        label,
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
        ratio("distinct_values", "total_rows").alias("cardinality_ratio"),
    )


def lowest_cardinality(df: DataFrame, limit: int = 10, approx: bool = False) -> DataFrame:
    """The columns with the smallest distinct-to-rows ratio, ties by name."""
    return column_cardinality(df, approx=approx).orderBy("cardinality_ratio", "column_name").limit(limit)


def json_cardinality(
    df: DataFrame, fields: Sequence[tuple[str, str]], literal_key: bool = False
) -> DataFrame:
    """Cardinality of JSON fields given as (column, dotted path), ascending ratio.

    ``literal_key`` treats the whole path as one key.
    """
    values = df.select(*[json_text(c, p, literal_key).alias(f"{c}.{p}") for c, p in fields])
    counted = _one_row_each(_count_pairs(values), [f"{c}.{p}" for c, p in fields], "json_field")
    return counted.orderBy("cardinality_ratio", "json_field")


def value_frequency(df: DataFrame, value: Column | str, label: str) -> DataFrame:
    """Frequency and share of each value, NULL kept as a group, most frequent first.

    The grand total is a scalar subquery over the grouped counts, not a window
    over all groups.
    """
    counts = df.groupBy(as_column(value).alias("value")).agg(F.count(F.lit(1)).alias("frequency"))
    total = counts.agg(F.sum("frequency").alias("n")).scalar()
    return counts.select(
        F.lit(label).alias("column_name"), "value", "frequency", ratio(F.col("frequency"), total).alias("percentage")
    ).orderBy(F.desc("frequency"), F.asc_nulls_last("value"))


def json_frequency(df: DataFrame, column: str, path: str) -> DataFrame:
    return value_frequency(df, json_text(column, path), f"{column}.{path}")


def array_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per array column: non-null rows, distinct arrays, mean length of non-empty arrays."""
    arrays = df.select(*columns).unpivot([], list(columns), "column_name", "items").filter("items IS NOT NULL")
    distinct = arrays.groupBy("column_name", "items").agg(F.count(F.lit(1)).alias("_n"))
    length = array_length("items")
    return (
        distinct.groupBy("column_name")
        .agg(
            F.sum("_n").alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_arrays"),
            rounded_mean(F.sum(length * F.col("_n")), F.sum(F.when(length.isNotNull(), F.col("_n")))).alias(
                "avg_array_length"
            ),
        )
        .orderBy("column_name")
    )


def array_element_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per array column: distinct elements and min, max and mean element frequency."""
    arrays = df.select(*columns).unpivot([], list(columns), "column_name", "items")
    elements = arrays.select("column_name", F.explode("items").alias("element"))
    frequency = elements.groupBy("column_name", "element").agg(F.count(F.lit(1)).alias("frequency"))
    return (
        frequency.groupBy("column_name")
        .agg(
            F.count("element").alias("unique_elements"),
            F.min("frequency").alias("min_frequency"),
            F.max("frequency").alias("max_frequency"),
            rounded_mean(F.sum("frequency"), F.count(F.lit(1))).alias("avg_frequency"),
        )
        .orderBy("column_name")
    )


def column_sizes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Bytes of each column's values (binary as is, others in text form) and of all of them."""
    columns = list(columns or df.columns)

    def size(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(col))
        return F.octet_length(col if isinstance(field.dataType, T.BinaryType) else col.cast("string"))

    sums = df.agg(*[F.coalesce(F.sum(size(df.schema[c])), F.lit(0)).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    rows = sums.withColumn("total_bytes", total).unpivot(["total_bytes"], columns, "column_name", "column_bytes")
    return rows.select("column_name", "column_bytes", "total_bytes")


def month_counts(df: DataFrame, timestamp: str, year: int, prefix: str = "") -> DataFrame:
    """Rows per month partition of a year, empty months included, then a TOTAL row.

    One scan; only the year's rows are read where the filter can be pushed down.
    """
    kind = df.schema[timestamp].dataType
    low, high = F.lit(date(year, 1, 1)).cast(kind), F.lit(date(year + 1, 1, 1)).cast(kind)
    counts = (
        df.filter((F.col(timestamp) >= low) & (F.col(timestamp) < high))
        .groupBy(F.month(timestamp).alias("_month"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    calendar = df.sparkSession.range(1, 13, 1, 1).select(F.col("id").cast("int").alias("_month"))
    named = calendar.join(counts, "_month", "left").select(
        F.format_string(f"{prefix}y%04dm%02d", F.lit(year), "_month").alias("partition_name"),
        F.coalesce("_n", F.lit(0)).alias("_n"),
    )
    rolled = named.rollup("partition_name").agg(
        F.sum("_n").alias("row_count"), F.grouping("partition_name").alias("_is_total")
    )
    return rolled.orderBy("_is_total", "partition_name").select(
        F.coalesce("partition_name", F.lit("TOTAL")).alias("partition_name"), "row_count"
    )
