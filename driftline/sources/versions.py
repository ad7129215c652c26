"""Tables that are replaced as a whole: numbered version folders, each published by a marker file written last.

Readers take the highest published version, so a table is there, old or new, at every moment of a replacement, and a
replacement that dies leaves a folder without a marker, which the next one removes. Neither a rename nor a lock is needed,
so object stores serve as well. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKER = "_PUBLISHED"
#: Published versions that stay beside the current one, for readers that still hold them.
KEEP = 1


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _store(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> dict[int, bool]:
        """Version numbers below the root, and whether each is published."""
        store = self._store()
        if not store.exists(self._path()):
            return {}
        names = [entry.getPath().getName() for entry in store.listStatus(self._path())]
        numbers = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
        return {n: store.exists(self._path(f"{self._name(n)}/{MARKER}")) for n in numbers}

    @staticmethod
    def _name(number: int) -> str:
        return f"v{number:08d}"

    def current(self) -> str | None:
        """Folder of the current version; None before the first."""
        numbers = [n for n, published in self._numbers().items() if published]
        return f"{self.root}/{self._name(numbers[-1])}" if numbers else None

    def publish(self, write: Callable[[str], None]) -> str:
        """Let ``write`` fill the folder of the next version, then make it the current one; returns the folder."""
        published = [n for n, done in self._numbers().items() if done]
        number = published[-1] + 1 if published else 1
        folder = f"{self.root}/{self._name(number)}"
        self._store().delete(self._path(self._name(number)), True)
        write(folder)
        self._mark(number)
        self._clear(number)
        return folder

    def _mark(self, number: int) -> None:
        self._store().create(self._path(f"{self._name(number)}/{MARKER}"), True).close()

    def _clear(self, number: int) -> None:
        """Remove versions older than the kept ones."""
        older = [n for n in self._numbers() if n < number]
        for n in older[: len(older) - KEEP]:
            self._store().delete(self._path(self._name(n)), True)

    def replace(self, rows: DataFrame, **options: str) -> DataFrame:
        """Write the rows as the next version and read it."""
        folder = self.publish(lambda path: rows.write.options(**options).parquet(path))
        return self.spark.read.schema(rows.schema).parquet(folder)

    def file_count(self) -> int:
        """Data files of the current version."""
        folder = self.current()
        if folder is None:
            return 0
        entries = self._store().listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(folder))
        return sum(not entry.getPath().getName().startswith(("_", ".")) for entry in entries)
