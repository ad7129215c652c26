"""Station metadata load: parse, keep the first line per station, leave existing stations alone."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.relational import new_rows
from driftline.schemas import WEATHER_STATION
from driftline.sources.fixed_width import read_stations
from driftline.sources.rejects import refuse_rejects
from driftline.sources.sinks import ZSTD


def read_station_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(WEATHER_STATION).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WEATHER_STATION)


def load_stations(spark: SparkSession, lines: str | list[str], path: str) -> None:
    """Append stations of fixed-width files whose id the table does not hold yet.

    Row ids follow the lines of a file, so the first line of an id is kept.
    """
    parsed = refuse_rejects(read_stations(spark, lines)).withColumn("_line", F.monotonically_increasing_id())
    added = new_rows(read_station_table(spark, path), parsed, ["station_id"], ["_line"])
    added.select(*WEATHER_STATION.fieldNames()).write.mode("append").options(**ZSTD).parquet(path)
