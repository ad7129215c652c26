"""Continuously maintained monthly mean."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.scalar import as_column, month_start, ratio

PARTIAL = "month date, category string, value_sum decimal(38,6), value_count long"
_LABELLED = f"{PARTIAL}, batch_id long"


def partial_sums(rows: DataFrame, timestamp: str, value: str, category: str, wanted: str | None = None) -> DataFrame:
    """Exact sum and count per month and category of a batch of rows; the value is a decimal."""
    if wanted is not None:
        rows = rows.filter(as_column(category) == F.lit(wanted))
    groups = rows.groupBy(month_start(timestamp).cast("date").alias("month"), F.col(category).cast("string").alias("category"))
    return groups.agg(F.sum(value).cast("decimal(38,6)").alias("value_sum"), F.count(value).alias("value_count"))


def one_file(sums: DataFrame) -> DataFrame:
    """A few rows, months times categories, for one file.

    They are shuffled once more: merged without it, one task would hold the aggregates of all shuffle partitions together.
    """
    return sums.repartition(1)


def maintain(
    stream: DataFrame, path: str, checkpoint: str, timestamp: str, value: str, category: str, wanted: str | None = None
) -> StreamingQuery:
    """Write each micro-batch's partial sums under its number; ``current_means`` adds them up.

    No state and no watermark: a row counts however late it comes, and a micro-batch that is retried replaces itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        sums = partial_sums(batch, timestamp, value, category, wanted)
        one_file(sums).write.mode("overwrite").parquet(f"{path}/partial/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet rows of a folder, none if it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _open_sums(spark: SparkSession, path: str) -> DataFrame:
    """The newest compacted sums and all partial sums of later micro-batches."""
    compacted = read_or_empty(spark, f"{path}/compacted", f"{PARTIAL}, through long")
    last = compacted.agg(F.max("through")).first()[0]
    done = -1 if last is None else last
    later = read_or_empty(spark, f"{path}/partial", _LABELLED).filter(F.col("batch_id") > done)
    return compacted.filter(F.col("through") == done).drop("through").union(later.drop("batch_id"))


def compact(spark: SparkSession, path: str) -> None:
    """Fold all partial sums into one folder named after the last micro-batch it holds.

    Readers take the newest complete folder and later micro-batches, so a crash half-way leaves the old one in force. What
    the folder in force before this call had already folded is removed; a reader that began with that folder keeps its files.
    """
    last = read_or_empty(spark, f"{path}/partial", _LABELLED).agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    before = read_or_empty(spark, f"{path}/compacted", f"{PARTIAL}, through long").agg(F.max("through")).first()[0]
    if before == last:
        return
    one_file(_added(_open_sums(spark, path))).write.mode("overwrite").parquet(f"{path}/compacted/through={last}")
    if before is not None:
        remove_numbered(spark, f"{path}/partial", "batch_id=", before)
        remove_numbered(spark, f"{path}/compacted", "through=", before - 1)


def remove_numbered(spark: SparkSession, folder: str, prefix: str, last: int) -> None:
    """Remove the numbered folders up to ``last``."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in store.listStatus(top):
        name = entry.getPath().getName()
        if name.startswith(prefix) and int(name.removeprefix(prefix)) <= last:
            store.delete(entry.getPath(), True)


def _added(sums: DataFrame) -> DataFrame:
    return sums.groupBy("month", "category").agg(
        F.sum("value_sum").cast("decimal(38,6)").alias("value_sum"), F.sum("value_count").alias("value_count")
    )


def current_means(spark: SparkSession, path: str) -> DataFrame:
    """Mean per month and category over everything streamed so far."""
    return _added(_open_sums(spark, path)).select(
        "month", "category", ratio(F.col("value_sum"), F.col("value_count")).alias("avg_value")
    )
