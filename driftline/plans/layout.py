"""Partition labels, range checks and the filters that let Spark skip partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column
from driftline.operators.climate import between_dates
from driftline.sources.rejects import REASON
from driftline.sources.sinks import write_columnar

FIRST_YEAR, LAST_YEAR = 1750, 2024
DEFAULT_PARTITION = "p_default"
YEAR_COLUMN = "obs_part"
MONTH_COLUMN = "month_part"


def year_partition(day: Column | str, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> Column:
    """``p<year>`` inside the range, the default partition for everything else and NULL."""
    year = F.year(as_column(day))
    label = F.concat(F.lit("p"), F.lpad(year.cast("string"), 4, "0"))
    return F.when(year.between(first, last), label).otherwise(F.lit(DEFAULT_PARTITION))


def month_label(timestamp: Column | str) -> Column:
    """``y2024m07``."""
    timestamp = as_column(timestamp)
    return F.format_string("y%04dm%02d", F.year(timestamp), F.month(timestamp))


def route_months(df: DataFrame, timestamp: str, year: int = 2024) -> DataFrame:
    """Add the month partition; a row outside the year fails the job."""
    message = F.concat(F.lit("no partition for "), F.coalesce(F.col(timestamp).cast("string"), F.lit("NULL")))
    inside = F.coalesce(F.year(timestamp) == year, F.lit(False))
    return df.withColumn(MONTH_COLUMN, F.when(inside, month_label(timestamp)).otherwise(F.raise_error(message)))


def mark_month_range(df: DataFrame, timestamp: str, year: int = 2024) -> DataFrame:
    """Add the month partition and a reject reason instead of failing."""
    inside = F.coalesce(F.year(timestamp) == year, F.lit(False))
    return df.withColumn(MONTH_COLUMN, F.when(inside, month_label(timestamp))).withColumn(
        REASON, F.when(~inside, F.lit("range"))
    )


def years_between(first: date, last: date) -> list[str]:
    """Year partitions that can hold dates of a closed range."""
    names = [f"p{y:04d}" for y in range(max(first.year, FIRST_YEAR), min(last.year, LAST_YEAR) + 1)]
    leaves_range = first.year < FIRST_YEAR or last.year > LAST_YEAR
    return names + [DEFAULT_PARTITION] if leaves_range else names


def prune_years(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Closed date range plus the partition filter it implies.

    Spark does not derive the partition label from the date, so the label list
    is stated next to the date range; the scan then lists only those folders.
    """
    return df.filter(F.col(YEAR_COLUMN).isin(years_between(first, last))).filter(
        between_dates(df, column, first, last)
    )


def prune_months(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """The same for month partitions."""
    months = []
    year, month = first.year, first.month
    while (year, month) <= (last.year, last.month):
        months.append(f"y{year:04d}m{month:02d}")
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return df.filter(F.col(MONTH_COLUMN).isin(months)).filter(between_dates(df, column, first, last))


def write_daily(observations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Daily observations by year partition; its files hold disjoint ranges of station and date, so lookups skip most."""
    write_columnar(
        observations.withColumn(YEAR_COLUMN, year_partition("observation_date")),
        path,
        cluster_by=[YEAR_COLUMN],
        sort_by=["station_id", "observation_date"],
        partition_by=[YEAR_COLUMN],
        by_range=True,
        mode=mode,
    )


def write_months(df: DataFrame, path: str, timestamp: str, sort_by: list[str], year: int = 2024) -> None:
    """A month-partitioned table; refuses rows outside its year."""
    write_columnar(
        route_months(df, timestamp, year),
        path,
        cluster_by=[MONTH_COLUMN],
        sort_by=sort_by,
        partition_by=[MONTH_COLUMN],
        by_range=True,
    )
