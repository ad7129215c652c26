"""Helpers that several operators share: work tables, word hashes, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import work_path

#: Entries that a task's word memo may hold before it is emptied; it bounds a worker's memory.
MEMO_ENTRIES = 150_000


#: Rows of an Arrow batch unless the session says otherwise; with long texts Spark's own default makes large batches.
BATCH_ROWS = 2_000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that they need not have it installed.

    Also bounds the rows of Arrow batches, where the session has Spark's default.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, str(file.relative_to(root.parent)))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class WordHash(dict):
    """Memo of 64-bit hashes of words (bytes)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(memo: WordHash, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalising 64-bit mixer, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes | None) -> list[bytes]:
    """Words between the six ASCII white-space characters, A-Z lower-cased; a null has none.

    ``bytes`` methods know ASCII only, which is just what the contracts ask for.
    """
    return text.lower().split() if text else []


def batch_values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def text_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and the text as bytes, so that tasks need not decode it."""
    return docs.select(*keep, F.col("text").cast("binary").alias("text"))


def _stars(parent: dict[int, int]) -> tuple[list[int], list[int]]:
    nodes, roots = [], []
    for x in parent:
        root = x
        while parent[root] != root:
            root = parent[root]
        if root != x:
            nodes.append(x)
            roots.append(root)
    return nodes, roots


def joined(parent: dict[int, int], a: int, b: int) -> None:
    """Union of two nodes; the smaller root stays."""
    for x in (a, b):
        parent.setdefault(x, x)
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    while parent[b] != b:
        parent[b] = parent[parent[b]]
        b = parent[b]
    if a < b:
        parent[b] = a
    elif b < a:
        parent[a] = b


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parent: dict[int, int] = {}
        for a, b in zip(batch_values(batch, "a"), batch_values(batch, "b"), strict=True):
            joined(parent, a, b)
        nodes, roots = _stars(parent)
        yield pa.record_batch({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})


#: Edges, after each task has reduced its own to a forest, up to which one task finishes the work (16 bytes each).
ONE_TASK_EDGES = 200_000


def _last_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch_values(batch, "a"), batch_values(batch, "b"), strict=True):
            joined(parent, a, b)
    nodes, roots = _stars(parent)
    yield pa.record_batch({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, component_id) of every node with an edge; ``edges`` has long columns a and b.

    Each batch is first reduced to a spanning forest. Up to ONE_TASK_EDGES edges of all forests, a counted bound, are united
    in one task. Beyond it, large-star and small-star rounds run until no edge changes: minima are aggregates with a
    map-side step and the way back is a join that adaptive execution can split, so a node with very many edges is no one
    task's burden. Either way gives the same result. Null ends are no edges.
    """
    ship(edges.sparkSession)
    e = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    e = written(e.mapInArrow(_forest, "a long, b long"), "edges")
    if e.count() <= ONE_TASK_EDGES:
        e = written(e.coalesce(1).mapInArrow(_last_forest, "a long, b long"), "edges")
        return e.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(e.select("b", "b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("n > m").select("n", "m")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(low, large.a == low.n).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.union(low.select("n", "m")).distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components need more than {max_rounds} rounds")
    ids = e.groupBy("a").agg(F.min("b").alias("component_id")).select(F.col("a").alias("id"), "component_id")
    return ids.union(e.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


