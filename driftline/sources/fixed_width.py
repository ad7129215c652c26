"""Fixed-width weather files: daily observations and station metadata.

Parsing is a chain of built-in expressions over ``spark.read.text``; a file is
split over as many tasks as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.scalar import blank_to_null, date_from_parts, fixed_slice, has_text, sentinel_to_null
from driftline.sources.rejects import with_reason

MISSING_READING = -9999
MISSING_ELEVATION = "-999.9"
DAYS_PER_LINE = 31
DAY_OFFSET = 21
DAY_WIDTH = 8

# Layout of a station line (field, first character, length).
STATION_LAYOUT = [
    ("station_id", 0, 11),
    ("latitude", 12, 8),
    ("longitude", 21, 9),
    ("elevation", 31, 6),
    ("state", 38, 2),
    ("station_name", 41, 30),
    ("gsn_flag", 72, 3),
    ("hcn_crn_flag", 76, 3),
    ("wmo_id", 80, 5),
]


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with the file they came from."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_file"))


def parse_daily_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per reading of a month line, plus ``reject_reason``.

    A line holds station, year, month, element and 31 day groups of value and
    three flags. Missing readings are dropped. A line without a readable year or
    month gives one reject; an unreadable value or a reading on a day that does
    not exist rejects that day only. Other input columns are kept.
    """
    keep = [c for c in lines.columns if c != column]
    line = F.col(column)
    # The day groups are cut to an array with the header, as one generated row, so that the line itself is neither
    # copied per day nor parsed again for each of them.
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(DAYS_PER_LINE - 1)),
        lambda d: F.struct(d.alias("_day"), fixed_slice(line, F.lit(DAY_OFFSET) + d * DAY_WIDTH, DAY_WIDTH).alias("_group")),
    )
    # The missing marker fills its field, so it is recognised before any number is parsed.
    groups = F.filter(groups, lambda g: ~g["_group"].startswith(str(MISSING_READING)))
    header = F.struct(
        F.rtrim(fixed_slice(line, 0, 11)).alias("station_id"),
        F.trim(fixed_slice(line, 11, 4)).try_cast("int").alias("_year"),
        F.trim(fixed_slice(line, 15, 2)).try_cast("int").alias("_month"),
        F.rtrim(fixed_slice(line, 17, 4)).alias("element"),
        groups.alias("_groups"),
    )
    lined = lines.select(*keep, F.inline(F.array(header)))
    bad_line = F.col("_year").isNull() | F.col("_month").isNull()
    one = F.array(F.struct(F.lit(0).alias("_day"), F.lit("").alias("_group")))
    days = lined.select(*keep, "station_id", "_year", "_month", "element", F.inline(F.when(bad_line, one).otherwise(F.col("_groups"))))
    readings = days.select(
        "*",
        F.trim(fixed_slice("_group", 0, 5)).try_cast("int").alias("_reading"),
        date_from_parts("_year", "_month", F.col("_day") + 1).alias("_date"),
    )
    reason = (
        F.when(bad_line, F.lit("line"))
        .when(F.col("_reading").isNull(), F.lit("value"))
        .when(F.col("_date").isNull(), F.lit("date"))
    )
    columns = [
        F.col("station_id"),
        F.col("_date").alias("observation_date"),
        F.col("element"),
        F.col("_reading").cast("decimal(18,4)").alias("value"),
        *[blank_to_null(fixed_slice("_group", 5 + i, 1)).alias(flag) for i, flag in enumerate(("mflag", "qflag", "sflag"))],
    ]
    return with_reason(readings, keep, columns, reason)


def read_daily(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Daily observations of fixed-width files with ``source_file`` and ``reject_reason``."""
    return parse_daily_lines(read_lines(spark, paths))


def parse_station_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Station metadata rows plus ``reject_reason``; blank lines are skipped."""
    keep = [c for c in lines.columns if c != column]
    raw = lines.filter(has_text(column)).select(
        *keep, *[F.trim(fixed_slice(column, at, width)).alias(name) for name, at, width in STATION_LAYOUT]
    )
    latitude = F.col("latitude").try_cast("decimal(8,4)")
    longitude = F.col("longitude").try_cast("decimal(9,4)")
    elevation = F.col("elevation").try_cast("decimal(5,1)")
    reason = (
        F.when(latitude.isNull(), F.lit("latitude"))
        .when(longitude.isNull(), F.lit("longitude"))
        .when(elevation.isNull(), F.lit("elevation"))
    )
    missing = F.lit(MISSING_ELEVATION).cast("decimal(5,1)")
    columns = [
        F.col("station_id"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.nullif(elevation, missing).alias("elevation"),
        sentinel_to_null("state", "").alias("state"),
        F.col("station_name"),
        *[sentinel_to_null(c, "").alias(c) for c in ("gsn_flag", "hcn_crn_flag", "wmo_id")],
    ]
    return with_reason(raw, keep, columns, reason)


def read_stations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_station_lines(read_lines(spark, paths))


def _plain_number(name: str) -> Column:
    """A decimal without trailing zeros, but with one digit after the point: 0.0005, 12.5, 3.0."""
    return F.regexp_replace(F.col(name).cast("string"), r"(\.\d+?)0+$", "$1")


def station_report(stations: DataFrame) -> DataFrame:
    """One text line per station, ready for ``write.text``; missing values print as None."""
    # The labels of the report.
    labels = [
        ("Station ID", F.col("station_id")),
        ("Latitude", _plain_number("latitude")),
        ("Longitude", _plain_number("longitude")),
        ("Elevation", _plain_number("elevation")),
        ("State", F.col("state")),
        ("Name", F.col("station_name")),
        ("GSN Flag", F.col("gsn_flag")),
        ("HCN/CRN Flag", F.col("hcn_crn_flag")),
        ("WMO ID", F.col("wmo_id")),
    ]
    template = ", ".join(f"{label}: %s" for label, _ in labels)
    values = [F.coalesce(value, F.lit("None")) for _, value in labels]
    return stations.select(F.format_string(template, *values).alias("value"))
