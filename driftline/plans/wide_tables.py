"""Loads of the three migration tables: text-format files to month-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from driftline.operators.keys import surrogate_key
from driftline.operators.sketch import fill_month_sketches
from driftline.plans.layout import write_months
from driftline.schemas import ALL_FACTS, BEESWAX, WIN_LOGS, without
from driftline.sources.delimited import format_text_lines, read_text_format
from driftline.sources.rejects import refuse_rejects

SKETCH_COLUMNS = [f.name for f in ALL_FACTS.fields if isinstance(f.dataType, T.BinaryType)]
ARRAY_COLUMNS = [f.name for f in ALL_FACTS.fields if isinstance(f.dataType, T.ArrayType)]


def export_text(df: DataFrame, path: str) -> None:
    """Rows to text-format files, one per task."""
    format_text_lines(df).write.mode("overwrite").text(path)


def _strict(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Text-format rows; a single bad row refuses the load."""
    return refuse_rejects(read_text_format(spark, paths, schema)).select(*schema.fieldNames())


def load_win_logs(spark: SparkSession, paths: str | list[str], target: str) -> None:
    rows = surrogate_key(_strict(spark, paths, without(WIN_LOGS, "id")))
    write_months(rows, target, "timestamp_col1", ["timestamp_col1", "id"])


def load_beeswax(spark: SparkSession, paths: str | list[str], target: str) -> None:
    rows = surrogate_key(_strict(spark, paths, without(BEESWAX, "id")))
    write_months(rows, target, "created_at", ["created_at", "id"])


def load_all_facts(spark: SparkSession, paths: str | list[str], target: str) -> None:
    """Staged columns plus month sketches; sketch columns of the file are not part of the load."""
    staged = _strict(spark, paths, without(ALL_FACTS, *SKETCH_COLUMNS))
    facts = fill_month_sketches(staged, "event_time", SKETCH_COLUMNS)
    write_months(facts.select(*ALL_FACTS.fieldNames()), target, "event_time", ["event_time"])
