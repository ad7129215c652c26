"""Climate queries: anomaly and sea-ice views, yearly and monthly means, audits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.scalar import date_from_parts, month_start, year_of
from driftline.schemas import MONTH_NAMES


def mean_of(df: DataFrame, name: str) -> Column:
    """Mean as double; decimals are summed exactly before the division."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.try_divide(F.sum(name).cast("double"), F.count(name).cast("double"))
    return F.avg(name)


def yearly_anomaly_long(anomalies: DataFrame) -> DataFrame:
    """Twelve (year, month) rows per yearly row; missing months stay as NULL rows."""
    pairs = ", ".join(f"{no}, '{name}', {name.lower()}" for no, name in enumerate(MONTH_NAMES, start=1))
    return anomalies.selectExpr("year", f"stack(12, {pairs}) AS (month_no, month, temperature_anomaly)")


def measures_long(df: DataFrame, ids: list[str], measures: list[str]) -> DataFrame:
    """Wide to long for any set of same-typed measure columns, NULLs kept."""
    return df.select(*ids, *measures).unpivot(ids, measures, "measure", "value")


def sea_ice_by_date(extents: DataFrame) -> DataFrame:
    """Sea-ice rows keyed by a date built from year, month and day."""
    return extents.select(date_from_parts("year", "month", "day").alias("date"), "extent", "missing", "source_data")


def yearly_mean(df: DataFrame, date_column: str, value: str, year_column: str | None = None) -> DataFrame:
    """Mean per year, in year order; the year is taken from the date unless the table has one."""
    year = F.col(year_column) if year_column else year_of(date_column)
    return df.groupBy(year.alias("year")).agg(mean_of(df, value).alias("avg_value")).orderBy("year")


def yearly_mean_between(df: DataFrame, date_column: str, value: str, first: date, last: date) -> DataFrame:
    """Yearly mean over a closed date range.

    On a year-partitioned table pass the frame through ``prune_years`` first.
    """
    return yearly_mean(df.filter(between_dates(df, date_column, first, last)), date_column, value)


def between_dates(df: DataFrame, column: str, first: date, last: date) -> Column:
    """Closed date range that still pushes down when the column is a timestamp."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return F.col(column).between(F.lit(first), F.lit(last))
    kind = df.schema[column].dataType
    upper = F.date_add(F.lit(last), 1).cast(kind)
    return (F.col(column) >= F.lit(first).cast(kind)) & (F.col(column) < upper)


def monthly_mean(
    df: DataFrame, date_column: str, value: str, category: str | None = None, wanted: str | None = None
) -> DataFrame:
    """Mean per calendar month, optionally of one category only."""
    rows = df.filter(F.col(category) == F.lit(wanted)) if category else df
    return rows.groupBy(month_start(date_column).alias("month")).agg(mean_of(df, value).alias("avg_value"))


def date_bounds(df: DataFrame, date_column: str) -> DataFrame:
    return df.agg(
        F.min(date_column).alias("earliest_date"),
        F.max(date_column).alias("latest_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def distinct_years(df: DataFrame, date_column: str) -> DataFrame:
    return df.select(year_of(date_column).alias("year")).distinct().orderBy("year")


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total rows and NULL count per column, one pass, one row."""
    columns = columns or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
