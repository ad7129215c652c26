"""Surrogate keys and dense row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.session import ensure_checkpoint_dir

_PARTITION_SHIFT = 33


def surrogate_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique 64-bit key with gaps, assigned without a shuffle."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def dense_index(df: DataFrame, order_by: list[str], name: str = "row_index") -> DataFrame:
    """Consecutive numbers 0..n-1 in the given order.

    Rows are range-partitioned and sorted in parallel; a row's number is its
    place inside its partition plus the sizes of the partitions before it. Only
    one count per partition passes through a single task. ``order_by`` should be
    unique, which also keeps equal values from piling up in one partition. The
    placement is checkpointed so that both uses of it see the same rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _PARTITION_SHIFT))
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition: bounded by the partition count, not by the data.
    offsets = F.broadcast(offsets)
    local = F.col("_row") - F.shiftleft("_part", _PARTITION_SHIFT)
    return placed.join(offsets, "_part").withColumn(name, local + F.col("_offset")).drop("_row", "_part", "_offset")


def round_robin(df: DataFrame, order_by: list[str], readers: int, name: str = "reader") -> DataFrame:
    """Reader number of each row: position in order modulo the number of readers."""
    numbered = dense_index(df, order_by, "_position")
    return numbered.withColumn(name, F.pmod("_position", F.lit(readers)).cast("int")).drop("_position")
