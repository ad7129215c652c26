"""Exact distinct counts and value lookups of whole-number columns by bitmaps.

A value is a bit: its bucket (32,768 values) and its place there. Rows are folded to one bitmap of 4 KB per column and bucket
before anything is shuffled, so what moves is bounded by the range of the values and not by the number of rows. Bitmaps
of parts of a table can be kept and combined later, which distinct counts cannot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.scalar import ratio

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def whole_columns(df: DataFrame) -> list[str]:
    """Columns that bitmaps can hold."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _WHOLE)]


def _whole(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    return column.cast("int").cast("long") if isinstance(kind, T.BooleanType) else column.cast("long")


def value_bitmaps(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, bucket, bits, row_count) of whole-number columns; ``bits`` is null in the row that counts NULLs.

    One pass: columns are numbered, each value is one (column, bucket) pair, folded where the rows are.
    """
    columns = list(columns or whole_columns(df))
    cells = F.array(*[_whole(c, df.schema[c].dataType) for c in columns])
    pairs = df.select(*by, F.posexplode(cells).alias("_column", "value"))
    parts = pairs.select(*by, "_column", F.bitmap_bucket_number("value").alias("bucket"), F.bitmap_bit_position("value").alias("_bit"))
    folded = parts.groupBy(*by, "_column", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"), F.count(F.lit(1)).alias("row_count"))
    names = F.array(*[F.lit(c) for c in columns])
    bits = F.when(F.col("bucket").isNotNull(), F.col("bits"))
    return folded.select(*by, F.get(names, "_column").alias("column_name"), "bucket", bits.alias("bits"), "row_count")


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of several parts of a table as those of the whole, or of groups ``by`` of the parts."""
    merged = bitmaps.groupBy(*by, "column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("row_count").alias("row_count"))
    return merged.withColumn("bits", F.when(F.col("bucket").isNotNull(), F.col("bits")))


def bitmap_cardinality(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct values and their ratio per column, exactly. A (column, bucket) pair must be one row, see ``merge_bitmaps``."""
    counted = bitmaps.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("total_rows"), F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0).cast("long")).alias("distinct_values")
    )
    return counted.select(*by, "column_name", "total_rows", "distinct_values", ratio("distinct_values", "total_rows").alias("cardinality_ratio"))


def with_value(bitmaps: DataFrame, column: str, value: int, by: Sequence[str]) -> DataFrame:
    """Groups whose bitmap of a column holds a value: the lookup that a bitmap index answers without the rows."""
    wanted = bitmaps.filter((F.col("column_name") == column) & (F.col("bucket") == F.bitmap_bucket_number(F.lit(value).cast("long"))))
    place = F.bitmap_bit_position(F.lit(value).cast("long"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return wanted.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select(*by)
