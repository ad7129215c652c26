"""Row rejects: every tolerant reader marks bad rows in ``reject_reason``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.scalar import ratio

REASON = "reject_reason"


class RejectLimitExceeded(RuntimeError):
    """More rows failed to parse than the load allows."""


def with_reason(df: DataFrame, keep: list[str], columns: list[Column], reason: Column) -> DataFrame:
    """Select ``keep``, the parsed columns and the reject reason as one generated row.

    A filter on the reason cannot be pushed below a generator, so the parse
    expressions run once per row instead of once in the filter and once in the
    projection.
    """
    row = F.struct(*columns, reason.alias(REASON))
    return df.select(*keep, F.inline(F.array(row)))


def split_rejects(parsed: DataFrame, fail_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and the rejected rows with it.

    ``fail_file`` drops every row of a file that holds at least one reject.
    """
    good = parsed.filter(F.col(REASON).isNull()).drop(REASON)
    bad = parsed.filter(F.col(REASON).isNotNull())
    if fail_file:
        good = good.join(bad.select("source_file").distinct(), "source_file", "left_anti")
    return good, bad


def reject_rate(parsed: DataFrame, by: str | None = None) -> DataFrame:
    """Rows, rejects and reject share of a load, or of each file when ``by`` is given."""
    groups = parsed.groupBy(by) if by else parsed.groupBy()
    counted = groups.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_rows"),
    )
    return counted.withColumn("reject_ratio", ratio("rejected_rows", "total_rows"))


def over_limit(limit_percent: float) -> Column:
    """True where a ``reject_rate`` row breaks the limit."""
    return F.coalesce(F.col("reject_ratio") * 100 > F.lit(limit_percent), F.lit(False))


def enforce_reject_limit(parsed: DataFrame, limit_percent: float = 1.0) -> DataFrame:
    """Good rows of a load whose reject share stays within the limit, else an error.

    The rate is one aggregate over the parsed rows; nothing but its single row
    reaches the driver.
    """
    rate = reject_rate(parsed).withColumn("broken", over_limit(limit_percent)).first()
    if rate["broken"]:
        raise RejectLimitExceeded(
            f"{rate['rejected_rows']} of {rate['total_rows']} rows rejected, limit {limit_percent} percent"
        )
    return split_rejects(parsed)[0]


def refuse_rejects(parsed: DataFrame) -> DataFrame:
    """Good rows of a load that tolerates none: the first reject fails the job, in the same pass."""
    complaint = F.raise_error(F.concat(F.lit("row rejected: "), F.col(REASON))).cast("boolean")
    return parsed.filter(F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(complaint)).drop(REASON)
