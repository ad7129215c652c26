"""Incremental ingest: every input file once, a bounded number of files per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from driftline.sources.listing import canonical_path
from driftline.sources.rejects import REASON, over_limit, reject_rate

SOURCE = "source_file"


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    fmt: str = "csv",
    pattern: str | None = None,
    files_per_batch: int = 1000,
    **options,
) -> DataFrame:
    """Stream of new files with the file each row came from."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.options(**options).load(folder).withColumn(SOURCE, F.col("_metadata.file_path"))


def ingest(
    stream: DataFrame,
    facts_path: str,
    events_path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    reject_percent: float = 1.0,
) -> StreamingQuery:
    """Append each micro-batch and its per-file row counts, then stop when caught up.

    A stream of parsed rows with a reject reason (``stream_csv_with_rejects``) drops its bad rows; a file with more than
    ``reject_percent`` of them stores nothing and ends FAILED.

    Both outputs go to a folder named after the batch in overwrite mode, so a
    batch that is retried after a lost executor or driver replaces itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = prepare(batch) if prepare else batch
        rows = rows.withColumn(SOURCE, canonical_path(SOURCE, encoded=True))
        if REASON not in rows.columns:
            rows = rows.withColumn(REASON, F.lit(None).cast("string"))
        # Parsed once: rates, facts and counts all read the batch's staging folder.
        rows.write.mode("overwrite").parquet(f"{events_path}-staging")
        staged = spark.read.schema(rows.schema).parquet(f"{events_path}-staging")
        rates = reject_rate(staged, by=SOURCE).withColumn("refused", over_limit(reject_percent))
        good = staged.filter(F.col(REASON).isNull()).drop(REASON)
        good = good.join(rates.filter("refused").select(SOURCE), SOURCE, "left_anti").select(*[c for c in rows.columns if c != REASON])
        good.write.mode("overwrite").parquet(f"{facts_path}/batch_id={batch_id}")
        refused_text = F.format_string("rejected %d of %d rows", "rejected_rows", "total_rows")
        rates.select(
            F.col(SOURCE).alias("file_name"),
            F.when(F.col("refused"), F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"),
            F.current_timestamp().alias("last_updated"),
            F.when(F.col("refused"), F.lit(0)).otherwise(F.col("total_rows") - F.col("rejected_rows")).cast("long").alias("inserted_row_count"),
            F.when(F.col("refused"), refused_text).alias("error_condition"),
        ).write.mode("overwrite").parquet(f"{events_path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, facts_path: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(SOURCE, T.StringType())])
    return spark.read.schema(stored).parquet(facts_path).select(*schema.fieldNames())
