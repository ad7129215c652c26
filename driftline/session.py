"""Session construction and shared-folder lookup."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles, splits skewed join partitions and skewed
# rebalance partitions at run time; nothing here depends on the data volume.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording a Python stack frame per column call triples plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


# Adaptive execution merges small partitions at run time but never splits those of an aggregate, so it starts from many.
INITIAL_PARTITIONS = 2_000


def build_session(app_name: str = "driftline", input_bytes: int | None = None, cores: int = 1, **conf: str) -> SparkSession:
    """Create or reuse a session; the master is left to spark-submit unless given.

    Shuffles start with one partition per 128 MB of ``input_bytes``, or INITIAL_PARTITIONS where the input is not known.
    """
    first = INITIAL_PARTITIONS if input_bytes is None else shuffle_partitions_for(input_bytes, cores)
    sizes = {"spark.sql.shuffle.partitions": str(first), "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(first)}
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **sizes, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``.

    One partition per 128 MB, never below the core count. Adaptive execution
    merges what turns out too small, so erring on the high side is safe.
    """
    return max(cores, -(-input_bytes // TARGET_SHUFFLE_BYTES))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or what the application set.

    Without either it is a folder below the warehouse, which every session has and all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


_RUNS: dict[str, str] = {}


def work_path(spark: SparkSession, label: str) -> str:
    """Fresh path, below this application's own work folder, for tables a job hands to its next step.

    ``clean_work`` removes the folder; it runs by itself when the driver's Python ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"{shared_root(spark)}/driftline/run-{uuid.uuid4().hex}"
        atexit.register(_clean_quietly, spark, app)
    return f"{_RUNS[app]}/{label}-{uuid.uuid4().hex}"


def clean_work(spark: SparkSession) -> None:
    """Remove the application's own work folder and nothing else; later work paths start a new one."""
    _remove(spark, spark.sparkContext.applicationId)


def _remove(spark: SparkSession, app: str) -> None:
    folder = _RUNS.pop(app, None)
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clean_quietly(spark: SparkSession, app: str) -> None:
    try:
        _remove(spark, app)
    except Exception:  # noqa: BLE001  the session is gone already; nothing can be removed through it
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a configured folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
