"""Star catalogue load: compressed CSV files to a clustered Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.plans.isolation import load_isolated, whole_message
from driftline.schemas import STAR_CATALOGUE
from driftline.sources.delimited import scan_csv_with_rejects
from driftline.sources.listing import canonical_path, list_files
from driftline.sources.rejects import REASON
from driftline.sources.sinks import write_columnar

SOURCE = "source_file"


def load_star_files(
    spark: SparkSession,
    folder: str,
    target: str,
    schema: T.StructType = STAR_CATALOGUE,
    key: str = "source_id",
    pattern: str = "*.csv.gz",
) -> DataFrame:
    """Load every compressed CSV file of a folder; returns rows or error per file.

    One tolerant pass parses all files to a staging folder next to the target and marks bad rows; a file that holds one
    contributes nothing, by anti-join. A file whose compression is damaged is left out of the next attempt. Compressed
    files cannot be split; the staging folder can, so range bounds by key cost no second decompression, and files of the
    table hold disjoint key ranges.
    """
    listed = list_files(spark, folder, pattern).select(canonical_path("file_name").alias("file_name"))
    # The scan takes its paths from the driver, which holds the listing anyway.
    names = sorted(row.file_name for row in listed.collect())
    if not names:
        raise ValueError(f"no files found: {folder}/{pattern}")
    staging = f"{target.rstrip('/')}-staging"
    kept: list[str] = []
    damaged: list[tuple[str, str]] = []

    def attempt(files: list[str]) -> None:
        part = f"{staging}/part-{len(kept)}"
        rows = scan_csv_with_rejects(spark, files, schema)
        rows.withColumn(SOURCE, canonical_path(SOURCE, encoded=True)).write.mode("overwrite").parquet(part)
        kept.append(part)

    load_isolated(names, attempt, lambda name, error: damaged.append((name, whole_message(error))))
    fields = [*schema.fields, *(T.StructField(n, T.StringType()) for n in (SOURCE, REASON))]
    empty = spark.createDataFrame([], T.StructType(fields))
    rows = spark.read.schema(empty.schema).parquet(*kept) if kept else empty
    bad = rows.filter(F.col(REASON).isNotNull()).groupBy(SOURCE).agg(F.count(F.lit(1)).alias("bad"), F.min(REASON).alias("why"))
    good = rows.join(bad.select(SOURCE), SOURCE, "left_anti").select(*schema.fieldNames(), SOURCE)
    # Drop and create: every load replaces the table.
    write_columnar(good, target, cluster_by=[key], sort_by=[key], by_range=True)
    loaded = spark.read.schema(_stored(schema)).parquet(target).groupBy(SOURCE).agg(F.count(F.lit(1)).alias("n"))
    broken = spark.createDataFrame(damaged, "file_name string, damage string")
    report = (
        listed.join(loaded.withColumnRenamed(SOURCE, "file_name"), "file_name", "left")
        .join(bad.withColumnRenamed(SOURCE, "file_name"), "file_name", "left")
        .join(broken, "file_name", "left")
    )
    complaint = F.when(F.col("bad").isNotNull(), F.format_string("%d bad rows, first in %s", "bad", "why"))
    return report.select("file_name", F.coalesce("n", F.lit(0)).alias("loaded_rows"), F.coalesce("damage", complaint).alias("error"))


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SOURCE, T.StringType())])


def read_star_table(spark: SparkSession, target: str, schema: T.StructType = STAR_CATALOGUE) -> DataFrame:
    return spark.read.schema(_stored(schema)).parquet(target).select(*schema.fieldNames())
