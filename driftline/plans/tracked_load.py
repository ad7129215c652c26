"""Tracked bulk load of daily observation files.

State lives in two tables besides a staging folder that each claim overwrites. ``facts`` holds one folder per load batch;
``load_events`` is an append-only log with a row per file and state change, and
a row per station of every batch with the rows that the batch added. A
batch becomes visible only when its events are appended, so a crash before that
leaves an unreferenced folder, which the retry of the same claim overwrites.
Reconciliation adds up the log's station rows, so a claim reads no facts but its own.
The log is a versioned table: a compaction becomes current by a marker written last.
One writer at a time is assumed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.scalar import base_name, clock_time
from driftline.operators.relational import count_mismatch, first_per_key
from driftline.plans.isolation import load_isolated, whole_message
from driftline.plans.layout import YEAR_COLUMN, write_daily
from driftline.sources.versions import Versions
from driftline.schemas import DAILY_OBSERVATION, LOAD_EVENT
from driftline.sources.delimited import scan_csv_with_rejects
from driftline.sources.listing import canonical_path
from driftline.sources.rejects import REASON, RejectLimitExceeded, over_limit, reject_rate

# The states of a file.
PENDING, COMPLETED, FAILED = "PENDING", "COMPLETED", "FAILED"
# A claim's own log entry, whose time is the start of its load.
CLAIMED = "CLAIMED"
# Log entries with the rows that a batch added to a station.
COUNTED = "COUNTED"
#: Files of the log from which the next claim compacts it.
COMPACT_FILES = 64

_FACT = T.StructType(DAILY_OBSERVATION.fields + [T.StructField(YEAR_COLUMN, T.StringType())])
_STORED = T.StructType([*_FACT.fields, T.StructField("batch_id", T.StringType())])


class TrackedLoad:
    """Load job over one table root.

    ``station_of`` tells which station a file belongs to; by default the base
    name of the file is the station id.
    """

    def __init__(self, spark: SparkSession, root: str, station_of: Callable[[Column], Column] = base_name):
        self.spark = spark
        self.station_of = station_of
        self.facts_path = f"{root.rstrip('/')}/facts"
        self.log = Versions(spark, f"{root.rstrip('/')}/load_events")
        self.staging_path = f"{root.rstrip('/')}/staging"

    # --- control log -----------------------------------------------------------

    def events(self) -> DataFrame:
        folder = self.log.current()
        if folder is None:
            return self.spark.createDataFrame([], LOAD_EVENT)
        return self.spark.read.schema(LOAD_EVENT).parquet(folder)

    def _heads(self) -> tuple[int, int]:
        """Last event number and current file-list generation; 0 before the first."""
        last = self.events().agg(F.max("seq").alias("seq"), F.max("generation").alias("generation")).first()
        return last.seq or 0, last.generation or 0

    def state(self, generation: int | None = None) -> DataFrame:
        """Latest event of every file of the current file list."""
        events = self.events().filter(F.col("file_name").isNotNull())
        current = F.lit(generation) if generation is not None else events.agg(F.max("generation").alias("g")).scalar()
        listed = events.filter(F.col("generation") == current)
        return first_per_key(listed, ["file_name"], ["seq", "last_updated"], latest=True)

    def _append(self, events: DataFrame) -> None:
        missing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in LOAD_EVENT.fields}
        full = events.select(
            *[
                F.col(name).cast(LOAD_EVENT[name].dataType).alias(name) if name in events.columns else null
                for name, null in missing.items()
            ]
        )
        folder = self.log.current()
        if folder is None:
            self.log.replace(full)
        else:
            full.write.mode("append").parquet(folder)

    def initialise(self, files: DataFrame) -> None:
        """Start a new file list: every file PENDING, earlier lists are history."""
        seq, generation = (n + 1 for n in self._heads())
        self._append(
            files.select(
                canonical_path("file_name").alias("file_name"),
                F.lit(PENDING).alias("status"),
                F.current_timestamp().alias("last_updated"),
                F.lit(seq).alias("seq"),
                F.lit(generation).alias("generation"),
            ).dropDuplicates(["file_name"])
        )

    def reset(self) -> int:
        """Put every file back to PENDING, clearing counts and error; returns the number of files."""
        seq, generation = self._heads()
        state = self.state(generation)
        changed = state.count()
        self._append(
            state.select(
                "file_name",
                F.lit(PENDING).alias("status"),
                F.current_timestamp().alias("last_updated"),
                F.lit(seq + 1).alias("seq"),
                "generation",
            )
        )
        return changed

    def pending(self, limit: int) -> DataFrame:
        """The next files to load, by name."""
        return self.state().filter(F.col("status") == PENDING).orderBy("file_name").limit(limit)

    def compact(self) -> None:
        """Rewrite the log, one small file per claim, as one file; no entry is lost, wherever it stops.

        The new version becomes current when it is whole. Claims compact by themselves from COMPACT_FILES files.
        """
        self.log.replace(self.events().coalesce(1))

    # --- facts -------------------------------------------------------------------

    def facts(self) -> DataFrame:
        """Fact rows of all published batches.

        The batches, one short id per claim, are a filter on the partition column, so that other folders are not opened.
        """
        done = self.events().filter(F.col("batch_id").isNotNull()).select("batch_id").distinct().collect()
        try:
            stored = self.spark.read.schema(_STORED).parquet(self.facts_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _FACT)
        return stored.filter(F.col("batch_id").isin([r.batch_id for r in done])).select(*_FACT.fieldNames())

    def station_rows(self) -> DataFrame:
        """(station_id, row_count) of the fact table, from the log alone."""
        counted = self.events().filter(F.col("status") == COUNTED)
        return counted.groupBy("station_id").agg(F.sum("inserted_row_count").alias("row_count"))

    def _batch_rows(self, batch: str) -> DataFrame:
        """(station_id, row_count) of one batch, which need not be published."""
        rows = self.spark.read.schema(_FACT).parquet(f"{self.facts_path}/batch_id={batch}")
        return rows.groupBy("station_id").agg(F.count(F.lit(1)).alias("row_count"))

    # --- loading -------------------------------------------------------------------

    def load_files(self, limit: int = 1000, reject_percent: float = 1.0, distinct: bool = True) -> int:
        """Load the next files one by one in effect: a bad file fails alone.

        All claimed files are parsed together, once; a file with too many rejects is left out and marked FAILED. A file
        that breaks the job itself (missing, unreadable) is left out of the next attempt.
        """
        names, claim_seq, generation = self._claim(limit)
        broken: list[tuple[str, str]] = []

        def attempt(group: list[str]) -> None:
            batch = self._batch_id(group, claim_seq)
            rates = self._stage(group)
            self._write(batch, rates, reject_percent, distinct)
            self._publish(group, batch, rates, reject_percent, generation, claim_seq, broken)
            broken.clear()

        load_isolated(names, attempt, lambda name, error: broken.append((name, whole_message(error))))
        if broken:
            self._append(self._broken_events(broken, generation, claim_seq))
        return len(names)

    def load_batch(self, limit: int = 1000, reject_percent: float = 1.0) -> int:
        """Load the next files as one unit; too many rejects refuse the whole batch."""
        names, claim_seq, generation = self._claim(limit)
        if not names:
            return 0
        batch = self._batch_id(names, claim_seq)
        rates = self._stage(names)
        total, bad = sum(r.total_rows for r in rates), sum(r.rejected_rows for r in rates)
        if total and bad * 100.0 / total > reject_percent:
            raise RejectLimitExceeded(f"{bad} of {total} rows rejected, limit {reject_percent} percent")
        self._write(batch, rates, 100.0, distinct=False)
        self._publish(names, batch, rates, 100.0, generation, claim_seq, [])
        return len(names)

    def load_all(self, batch_size: int = 1000, **options) -> int:
        """Load until nothing is pending."""
        total = 0
        while done := self.load_files(batch_size, **options):
            total += done
        return total

    def _claim(self, limit: int) -> tuple[list[str], int, int]:
        """The next names, which are the scan's path list and so on the driver in any case, and the claim's number."""
        if self.log.file_count() >= COMPACT_FILES:
            self.compact()
        seq, generation = self._heads()
        pending = self.state(generation).filter(F.col("status") == PENDING).orderBy("file_name").limit(limit)
        names = [r.file_name for r in pending.select("file_name").collect()]
        self._begun = datetime.now(timezone.utc)
        return names, seq, generation

    def _batch_id(self, names: list[str], claim_seq: int) -> str:
        """Same claim, same id: a retry overwrites what a crashed attempt left."""
        return hashlib.sha256("\n".join([str(claim_seq), *names]).encode()).hexdigest()[:20]

    def _staged(self) -> DataFrame:
        fields = [*DAILY_OBSERVATION.fields, *(T.StructField(n, T.StringType()) for n in ("source_file", REASON))]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.staging_path)

    def _stage(self, names: list[str]) -> list[Row]:
        """Parse the files once to the staging folder, which each claim overwrites; rows and rejects per file, one row per claimed file at most."""
        parsed = scan_csv_with_rejects(self.spark, names, DAILY_OBSERVATION)
        parsed = parsed.withColumn("source_file", canonical_path("source_file", encoded=True))
        parsed.write.mode("overwrite").parquet(self.staging_path)
        return reject_rate(self._staged(), by="source_file").collect()

    def _write(self, batch: str, rates: list[Row], reject_percent: float, distinct: bool) -> None:
        """Write the batch folder; duplicates are removed within a file, not between files."""
        columns = DAILY_OBSERVATION.fieldNames()
        good = self._staged().filter(F.col(REASON).isNull())
        refused = [(r.source_file,) for r in rates if _refused(r, reject_percent)]
        if refused:
            names = self.spark.createDataFrame(refused, "source_file string")
            good = good.join(names, "source_file", "left_anti")
        rows = good.select("source_file", *columns).distinct() if distinct else good
        write_daily(rows.select(*columns), f"{self.facts_path}/batch_id={batch}")

    def _publish(
        self,
        names: list[str],
        batch: str,
        rates: list[Row],
        reject_percent: float,
        generation: int,
        claim_seq: int,
        broken: list[tuple[str, str]],
    ) -> None:
        """Compare file and table counts per station and append all events of the claim at once."""
        counted = {r.source_file: r for r in rates}
        claimed = self.spark.createDataFrame(
            [(n, counted[n].total_rows if n in counted else 0, counted[n].rejected_rows if n in counted else 0) for n in names],
            "file_name string, total_rows long, rejected_rows long",
        ).withColumn("station_id", self.station_of(F.col("file_name")))
        claimed = claimed.withColumn("reject_ratio", F.try_divide("rejected_rows", "total_rows"))
        refused = over_limit(reject_percent)
        added = self._batch_rows(batch)
        actual = self.station_rows().union(added).groupBy("station_id").agg(F.sum("row_count").alias("actual_count"))
        refused_text = F.format_string("rejected %d of %d rows", "rejected_rows", "total_rows")
        inserted = F.coalesce("actual_count", F.lit(0))
        mismatch = count_mismatch(F.col("total_rows"), F.col("actual_count"))
        events = claimed.join(actual, "station_id", "left").select(
            "file_name",
            F.when(refused, F.lit(FAILED)).otherwise(F.lit(COMPLETED)).alias("status"),
            F.current_timestamp().alias("last_updated"),
            F.when(~refused, F.col("total_rows")).alias("csv_record_count"),
            F.when(~refused, inserted).alias("inserted_row_count"),
            F.when(refused, refused_text).otherwise(mismatch).alias("error_condition"),
            F.lit(claim_seq + 1).alias("seq"),
            F.lit(batch).alias("batch_id"),
            F.lit(generation).alias("generation"),
        )
        events = events.unionByName(self._broken_events(broken, generation, claim_seq), allowMissingColumns=True)
        counted = added.select(
            "station_id", F.lit(COUNTED).alias("status"), F.col("row_count").alias("inserted_row_count"), F.lit(claim_seq + 1).alias("seq"),
            F.lit(batch).alias("batch_id"), F.lit(generation).alias("generation"),
        )
        events = events.unionByName(counted, allowMissingColumns=True)
        # One row per claimed file and per station in them: one file, so the batch appears at once.
        self._append(events.coalesce(1))

    def _broken_events(self, broken: list[tuple[str, str]], generation: int, claim_seq: int) -> DataFrame:
        """Final events of files that could not be read, and the claim's own entry with the time it began."""
        rows = [(n, FAILED, text, None) for n, text in broken] + [(None, CLAIMED, None, self._begun)]
        entries = self.spark.createDataFrame(rows, "file_name string, status string, error_condition string, begun timestamp")
        return entries.select(
            "file_name",
            "status",
            F.coalesce("begun", F.current_timestamp()).alias("last_updated"),
            "error_condition",
            F.lit(claim_seq + 1).alias("seq"),
            F.lit(generation).alias("generation"),
        )

    # --- statistics ------------------------------------------------------------------

    def statistics(self) -> DataFrame:
        """Files done, rows in the table, elapsed time and mean time per file.

        Time runs from the first claim of the current file list to its last final event.
        """
        _, generation = self._heads()
        state = self.state(generation)
        done = F.col("status") != PENDING
        claims = self.events().filter((F.col("generation") == generation) & (F.col("status") == CLAIMED))
        begun = claims.agg(F.min("last_updated").alias("t"))
        seconds = F.unix_timestamp(F.max(F.when(done, F.col("last_updated")))) - F.unix_timestamp(begun.scalar())
        total = self.station_rows().agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
        return (
            state.agg(F.count_if(done).alias("files_processed"), seconds.alias("elapsed_seconds"))
            .withColumn("total_rows", total.scalar())
            .withColumn("elapsed", clock_time("elapsed_seconds"))
            .withColumn(
                "mean_per_file", clock_time(F.try_divide(F.col("elapsed_seconds"), F.col("files_processed")).cast("long"))
            )
        )


def _refused(rate: Row, reject_percent: float) -> bool:
    return bool(rate.total_rows) and rate.rejected_rows * 100.0 / rate.total_rows > reject_percent
