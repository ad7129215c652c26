"""Data placement audits: key buckets, partitions, histograms and partition advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column, equal_width_bucket, pretty_size, ratio
from driftline.sources.listing import list_files


def bucket_counts(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    """Rows per bucket with the share of the table and the skew against the mean bucket."""
    counts = df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("row_count"))
    totals = counts.agg(F.sum("row_count").alias("n"), F.avg("row_count").alias("mean"))
    return counts.select(
        name,
        "row_count",
        (ratio(F.col("row_count"), totals.select("n").scalar()) * 100).alias("percentage"),
        ratio(F.col("row_count"), totals.select("mean").scalar()).alias("skew_ratio"),
    ).orderBy(name)


def key_distribution(df: DataFrame, key: Column | str, buckets: int) -> DataFrame:
    """Skew of a hash distribution of the key over n buckets."""
    return bucket_counts(df, F.pmod(F.xxhash64(as_column(key)), F.lit(buckets)).cast("int"))


def task_distribution(df: DataFrame) -> DataFrame:
    """Rows per Spark partition of the frame as it is laid out now."""
    return bucket_counts(df, F.spark_partition_id(), "partition_id")


def partition_counts(
    df: DataFrame, partition: Column | str, name: str = "partition_name", expected: list[str] | None = None
) -> DataFrame:
    """Rows per logical partition, by partition column or by a label taken from the path.

    ``expected`` names partitions that are listed even when they are empty, as a calendar or a listing gives them.
    """
    counts = df.groupBy(as_column(partition).alias(name)).agg(F.count(F.lit(1)).alias("row_count"))
    if expected is not None:
        empty = df.sparkSession.createDataFrame([(e,) for e in expected], f"{name} string").withColumn("row_count", F.lit(0).cast("long"))
        counts = counts.union(empty).groupBy(name).agg(F.sum("row_count").alias("row_count"))
    return counts.orderBy(name)


def partition_label(path: Column | str, column: str) -> Column:
    """Partition value in a file path."""
    return F.regexp_extract(as_column(path), f"/{column}=([^/]+)/", 1)


def partition_sizes(spark: SparkSession, table_path: str, partition: str) -> DataFrame:
    """Bytes on disk per partition, as a number and as text, from the file listing alone."""
    files = list_files(spark, table_path, "*.parquet")
    return (
        files.groupBy(partition_label("file_name", partition).alias("partition_name"))
        .agg(F.sum("file_size").alias("size_bytes"))
        .withColumn("total_size", pretty_size("size_bytes"))
        .orderBy("partition_name")
    )


def equal_width_histogram(df: DataFrame, value: str, buckets: int = 20) -> DataFrame:
    """Count, smallest and largest value per equal-width bucket over the column's range.

    The maximum lands in bucket n + 1; NULL values form a bucket of their own.
    """
    bounds = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    bucket = equal_width_bucket(F.col(value).cast("double"), low.cast("double"), high.cast("double"), buckets)
    return (
        df.groupBy(bucket.alias("bucket"))
        .agg(
            F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.count(F.lit(1)).alias("row_count")
        )
        .orderBy("bucket")
    )


def partition_advice(df: DataFrame, value: str, rows_per_partition: int = 2000) -> DataFrame:
    """Suggested number and width of range partitions: at most that many rows each on average."""
    stats = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )
    parts = F.ceil(F.col("total_rows") / F.lit(float(rows_per_partition))).cast("long")
    return stats.withColumn("num_partitions", parts).withColumn(
        "partition_width", F.try_divide(F.col("max_value") - F.col("min_value"), F.col("num_partitions").cast("double"))
    )
