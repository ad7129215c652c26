"""Synthetic rows for the three wide migration tables.

Values are hashes of (row id, column, seed): any task can produce any row, the
same seed always gives the same table, and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from driftline.schemas import ALL_FACTS, BEESWAX, WIN_LOGS, without

YEAR = 2024

# Fixed values of the generated documents.
FEATURES = ["feature1", "feature2", "feature3", "feature4"]
ENVIRONMENTS = ["prod", "stage", "dev"]
REGIONS = ["us-east-1", "us-west-2", "eu-west-1"]
TAGS = ["tag1", "tag2", "tag3", "tag4", "tag5"]


class RowValues:
    """Pseudo-random column expressions of one row id, as SQL text.

    Text keeps plan building cheap: a wide table has hundreds of columns and each
    is one expression to parse.
    """

    def __init__(self, seed: int):
        self.seed = seed

    def _hash(self, label: str, *more: str) -> str:
        return f"xxhash64({', '.join(['_id', repr(label), str(self.seed), *more])})"

    def whole(self, label: str, low: int, high: int, *more: str) -> str:
        """Integer in low..high."""
        return f"(pmod({self._hash(label, *more)}, {high - low + 1}L) + {low}L)"

    def real(self, label: str, high: float) -> str:
        return f"(CAST({self.whole(label, 0, (1 << 53) - 1)} AS DOUBLE) / {float(1 << 53)}D * {high}D)"

    def flag(self, label: str) -> str:
        return f"({self.whole(label, 0, 1)} = 1)"

    def pick(self, label: str, options: list[str]) -> str:
        return f"element_at({_texts(options)}, CAST({self.whole(label, 1, len(options))} AS INT))"

    def sample(self, label: str, options: list[str], most: int) -> str:
        """One to ``most`` different options."""
        ranked = f"array_sort(transform({_texts(options)}, o -> struct({self._hash(label, 'o')} AS h, o AS o)))"
        size = f"CAST({self.whole(label + '#', 1, most)} AS INT)"
        return f"transform(slice({ranked}, 1, {size}), s -> s.o)"

    def moment(self, label: str) -> str:
        """Second of the year; days of a month stop at 28."""
        ranges = {"m": (1, 12), "d": (1, 28), "h": (0, 23), "i": (0, 59), "s": (0, 59)}
        month, day, hour, minute, second = (self.whole(label + p, low, high) for p, (low, high) in ranges.items())
        parts = ", ".join(f"CAST({part} AS INT)" for part in (month, day, hour, minute, second))
        return f"make_timestamp_ntz({YEAR}, {parts})"

    def address(self, label: str) -> str:
        octets = ", ".join(f"CAST({self.whole(f'{label}.{i}', 0, 255)} AS STRING)" for i in range(4))
        return f"concat_ws('.', {octets})"

    def text_array(self, label: str) -> str:
        first, second = self.whole(label + "a", 1, 100, "i"), self.whole(label + "b", 1, 1000, "i")
        size = self.whole(label + "#", 1, 5)
        return f"transform(sequence(1L, {size}), i -> concat('text_', {first}, '_', {second}))"

    def numbered(self, prefix: str, label: str) -> str:
        return f"concat('{prefix}', {self.whole(label, 1, 1000)})"


def _texts(options: list[str]) -> str:
    return "array(" + ", ".join(repr(o) for o in options) + ")"


def _column(field: T.StructField, rows: RowValues) -> str:
    """Value range by declared type."""
    name, kind = field.name, field.dataType
    if isinstance(kind, T.IntegerType):
        value = rows.whole(name, 1, 1_000_000)
    elif isinstance(kind, T.LongType):
        value = rows.whole(name, 1, 1_000_000_000)
    elif isinstance(kind, T.DecimalType):
        value = f"CAST({rows.whole(name, 0, 100_000)} AS DECIMAL(18,0)) / 100"
    elif isinstance(kind, T.DoubleType):
        value = rows.real(name, 1000.0)
    elif isinstance(kind, T.BooleanType):
        value = rows.flag(name)
    elif isinstance(kind, T.TimestampNTZType):
        value = rows.moment(name)
    elif isinstance(kind, T.ArrayType):
        value = rows.text_array(name)
    elif name.startswith("inet"):
        value = rows.address(name)
    else:
        value = rows.numbered("varchar_" if name == "varchar_col" else "text_", name)
    return f"CAST({value} AS {kind.simpleString()}) AS {name}"


def _numbered_text(name: str, rows: RowValues) -> str:
    """Text columns that carry their position, counted from 0."""
    position = int(name.removeprefix("text_col")) - 1
    return f"{rows.numbered(f'text_{position}_', name)} AS {name}"


def _rows(spark: SparkSession, count: int, chunks: int) -> DataFrame:
    return spark.range(0, count, 1, chunks).withColumnRenamed("id", "_id")


def win_logs(spark: SparkSession, count: int, chunks: int = 8, seed: int = 0) -> DataFrame:
    """The 227 load columns of the wide log table."""
    rows = RowValues(seed)
    columns = [
        _numbered_text(f.name, rows) if f.name.startswith("text_col") else _column(f, rows)
        for f in without(WIN_LOGS, "id").fields
    ]
    return _rows(spark, count, chunks).selectExpr(*columns)


def all_facts(spark: SparkSession, count: int, chunks: int = 8, seed: int = 0) -> DataFrame:
    """The fact table without its sketch columns, which the load fills."""
    rows = RowValues(seed)
    sketches = [f.name for f in ALL_FACTS.fields if isinstance(f.dataType, T.BinaryType)]
    return _rows(spark, count, chunks).selectExpr(
        *[_column(f, rows) for f in without(ALL_FACTS, *sketches).fields]
    )


def beeswax(spark: SparkSession, count: int, chunks: int = 8, seed: int = 0) -> DataFrame:
    """The 21 load columns of the JSON table."""
    rows = RowValues(seed)
    settings = ", ".join(
        [
            f"CAST({rows.whole('timeout', 1000, 5000)} AS INT) AS timeout",
            f"CAST({rows.whole('retry_count', 1, 5)} AS INT) AS retry_count",
            f"{rows.sample('enabled_features', FEATURES, 3)} AS enabled_features",
        ]
    )
    config = f"struct(CAST({rows.whole('version', 1, 5)} AS INT) AS version, struct({settings}) AS settings)"
    metadata = ", ".join(
        [
            f"{rows.pick('environment', ENVIRONMENTS)} AS environment",
            f"{rows.pick('region', REGIONS)} AS region",
            f"{rows.sample('tags', TAGS, 4)} AS tags",
        ]
    )
    special = {
        "config_json": f"to_json({config}) AS config_json",
        "metadata_json": f"to_json(struct({metadata})) AS metadata_json",
    }
    columns = []
    for field in without(BEESWAX, "id").fields:
        if field.name in special:
            columns.append(special[field.name])
        elif field.name.startswith("text_col"):
            columns.append(_numbered_text(field.name, rows))
        else:
            columns.append(_column(field, rows))
    return _rows(spark, count, chunks).selectExpr(*columns)
