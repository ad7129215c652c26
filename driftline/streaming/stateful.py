"""Monthly mean kept in the state store, with a watermark; what comes past the watermark is added beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.scalar import as_column, month_start, ratio
from driftline.streaming.monthly import PARTIAL, one_file, read_or_empty, remove_numbered

#: ``late``: the sums are of rows past the watermark, to be added; else they are the state's totals, the newest counts.
_SUMS = f"{PARTIAL}, late boolean"
_SUM = "decimal(38,6)"


def maintain(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    timestamp: str,
    value: str,
    category: str,
    wanted: str | None = None,
    delay: str = "62 days",
) -> StreamingQuery:
    """Keep sum and count per month and category in state, for months that began at most ``delay`` before the newest month.

    Every micro-batch writes the totals that it changed. Spark drops a row from the aggregate if its month lies behind the
    watermark, which is so for all or none of a month's rows in a micro-batch: a month of the input without a changed total
    was dropped. Its sums are written as late ones, which ``current_means`` adds, so no row is lost however late it comes.
    A retried micro-batch replaces its own folder. Rows without a timestamp form a month of their own that stays in state.
    """
    if wanted is not None:
        stream = stream.filter(as_column(category) == F.lit(wanted))
    rows = stream.select(
        month_start(timestamp).cast("timestamp").alias("month"),
        F.col(category).cast("string").alias("category"),
        F.col(value).cast(_SUM).alias("value"),
    )
    kept = rows.withWatermark("month", delay).groupBy("month", "category")
    totals = kept.agg(F.sum("value").cast(_SUM).alias("value_sum"), F.count("value").alias("value_count"))
    nothing = F.lit(None)
    # Both branches read the same micro-batch; its rows and the totals that they changed meet in ``store``.
    both = totals.withColumn("value", nothing.cast(_SUM)).withColumn("kept", F.lit(True)).unionByName(
        rows.withColumns({"value_sum": nothing.cast(_SUM), "value_count": nothing.cast("long"), "kept": F.lit(False)})
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        groups = batch.groupBy(F.col("month").cast("date").alias("month"), "category").agg(
            F.max("kept").alias("kept"),
            F.max("value_sum").alias("total"), F.max("value_count").alias("total_count"),
            F.sum("value").cast(_SUM).alias("added"), F.count("value").alias("added_count"),
        )
        sums = groups.select(
            "month", "category",
            F.when(F.col("kept"), F.col("total")).otherwise(F.col("added")).alias("value_sum"),
            F.when(F.col("kept"), F.col("total_count")).otherwise(F.col("added_count")).alias("value_count"),
            (~F.col("kept")).alias("late"),
        )
        one_file(sums).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")

    return (
        both.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _changes(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest compacted folder and of all later micro-batches, ``batch_id`` telling their order."""
    compacted = read_or_empty(spark, f"{path}/compacted", f"{_SUMS}, through long")
    last = compacted.agg(F.max("through")).first()[0]
    done = -1 if last is None else last
    later = read_or_empty(spark, f"{path}/changes", f"{_SUMS}, batch_id long").filter(F.col("batch_id") > done)
    return compacted.filter(F.col("through") == done).withColumnRenamed("through", "batch_id").unionByName(later)


def _folded(changes: DataFrame) -> DataFrame:
    """One row per month, category and kind: the newest total of the state, the sum of what came late."""
    newest = F.max_by(F.struct("value_sum", "value_count"), "batch_id")
    groups = changes.groupBy("month", "category", "late").agg(
        newest.alias("newest"), F.sum("value_sum").cast(_SUM).alias("added"), F.sum("value_count").alias("added_count")
    )
    return groups.select(
        "month", "category", "late",
        F.when(F.col("late"), F.col("added")).otherwise(F.col("newest.value_sum")).alias("value_sum"),
        F.when(F.col("late"), F.col("added_count")).otherwise(F.col("newest.value_count")).alias("value_count"),
    )


def compact(spark: SparkSession, path: str) -> None:
    """Fold all changes into one folder named after the last micro-batch; a crash half-way leaves the one before in force.

    What the folder in force before this call had folded is removed. Not to be run while the stream runs.
    """
    last = read_or_empty(spark, f"{path}/changes", f"{_SUMS}, batch_id long").agg(F.max("batch_id")).first()[0]
    before = read_or_empty(spark, f"{path}/compacted", f"{_SUMS}, through long").agg(F.max("through")).first()[0]
    if last is None or last == before:
        return
    folded = _folded(_changes(spark, path)).select("month", "category", "value_sum", "value_count", "late")
    one_file(folded).write.mode("overwrite").parquet(f"{path}/compacted/through={last}")
    if before is not None:
        remove_numbered(spark, f"{path}/changes", "batch_id=", before)
        remove_numbered(spark, f"{path}/compacted", "through=", before - 1)


def late_sums(spark: SparkSession, path: str) -> DataFrame:
    """Sum and count per month and category of the rows that came past the watermark."""
    return _folded(_changes(spark, path)).where("late").drop("late")


def current_means(spark: SparkSession, path: str) -> DataFrame:
    """Mean per month and category over everything streamed so far: the state's totals and the late rows."""
    parts = _folded(_changes(spark, path)).groupBy("month", "category")
    sums = parts.agg(F.sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count"))
    return sums.select("month", "category", ratio(F.col("value_sum"), F.col("value_count")).alias("avg_value"))
