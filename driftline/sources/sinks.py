"""Writers: columnar tables, per-file CSV, reports, materialised results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.interleave import scales, with_cluster_key
from driftline.sources.versions import Versions

ZSTD = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def write_columnar(
    df: DataFrame,
    path: str,
    *,
    cluster_by: list[str],
    sort_by: list[str],
    partition_by: list[str] | None = None,
    by_range: bool = False,
    mode: str = "overwrite",
) -> None:
    """Zstd Parquet, rows clustered by key and sorted inside each file.

    The rebalance shuffle keeps equal keys together, merges small partitions and
    splits any partition a hot key makes too large, so file sizes stay even.
    ``by_range`` gives files disjoint key ranges instead; the sort columns take
    part in the ranges so that equal keys can spread over several files.
    """
    partition_by = partition_by or []
    if by_range:
        placed = df.repartitionByRange(*dict.fromkeys([*cluster_by, *sort_by]))
    else:
        placed = df.hint("rebalance", *cluster_by)
    placed = placed.sortWithinPartitions(*partition_by, *sort_by)
    writer = placed.write.mode(mode).options(**ZSTD)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_interleaved(df: DataFrame, path: str, columns: list[str], key: str = "cluster_key") -> None:
    """The rows in files of disjoint ranges of a bit-interleaved key of several columns, which is stored with them.

    A lookup by any of the columns, or by several, opens the files whose ranges allow it. The table is read before, for
    the quantiles that scale the columns.
    """
    placed = with_cluster_key(df, scales(df, columns), key)
    write_columnar(placed, path, cluster_by=[key], sort_by=[key, *columns], by_range=True)


def replace_partitions(df: DataFrame, path: str, *, partition_by: list[str], sort_by: list[str]) -> None:
    """Replace the partitions that the rows fall into and leave all others as they are.

    New files are staged beside the table and moved in when the whole write has succeeded, so a write that fails leaves the
    table as it was. A partition of which no row is given stays; a table that does not exist is created.
    """
    placed = df.repartitionByRange(*partition_by, *sort_by).sortWithinPartitions(*partition_by, *sort_by)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**ZSTD)
    writer.partitionBy(*partition_by).parquet(path)


def append_rows(
    target: str, rows: DataFrame, *, columns: list[str] | None = None, distinct: bool = False
) -> None:
    """Insert-select: project, optionally remove exact duplicates, append."""
    rows = rows.select(*columns) if columns else rows
    (rows.distinct() if distinct else rows).write.mode("append").options(**ZSTD).parquet(target)


def write_csv_per_source(df: DataFrame, path: str, source: str = "source_file") -> None:
    """A CSV folder with header per source file.

    Rows are grouped by source before the write; a very large source is split
    over several part files of its folder instead of one task.
    """
    df.hint("rebalance", source).sortWithinPartitions(source).write.mode("overwrite").partitionBy(source).option(
        "header", True
    ).csv(path)


def write_report(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def recreate_table(df: DataFrame, name: str) -> None:
    """Drop and create a catalogue table."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").saveAsTable(name)


def swap_table(df: DataFrame, name: str, root: str) -> str:
    """Rebuild what ``name`` shows: readers see the old rows until the new ones are written whole; returns their folder.

    The rows are a new version below ``root``, and the catalogue's view of that name is then pointed to it.
    """
    folder = Versions(df.sparkSession, root).publish(lambda path: df.write.options(**ZSTD).parquet(path))
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return folder


def truncate_or_create(empty: DataFrame, name: str) -> bool:
    """Empty an existing table or create it; True when it existed."""
    spark = empty.sparkSession
    existed = spark.catalog.tableExists(name)
    if existed:
        spark.sql(f"TRUNCATE TABLE {name}")
    else:
        empty.limit(0).write.format("parquet").saveAsTable(name)
    return existed


class MaterializedResult:
    """A query result kept as Parquet; ``refresh`` recomputes it and replaces the old one when the new one is whole."""

    def __init__(self, spark: SparkSession, path: str, query: Callable[[], DataFrame]):
        self.spark, self.query = spark, query
        self.versions = Versions(spark, path)

    def refresh(self) -> MaterializedResult:
        self.versions.replace(self.query(), **ZSTD)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.versions.current())


def with_load_time(df: DataFrame, name: str = "last_updated") -> DataFrame:
    """Default value of a load-time column."""
    return df.withColumn(name, F.current_timestamp())


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
