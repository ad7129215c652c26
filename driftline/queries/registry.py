"""Name, Spark job and equivalent SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Job
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Job], Job]:
    """Register the decorated job under its function name."""

    def register(job: Job) -> Job:
        REGISTRY[job.__name__] = Query(job, sql)
        return job

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
