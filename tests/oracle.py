"""Compare a Spark result with its SQL twin run by DuckDB on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.10g}")
    return value


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(_norm(v) for v in row) for row in zip(*columns, strict=True)), key=repr)


def _kinds(table) -> dict[str, str]:
    text = {"large_string": "string", "string_view": "string"}
    return {f.name: text.get(str(f.type), str(f.type)) for f in table.schema}


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in columns, types, row count and values; empty when equal."""
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    problems = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    kinds = {n: (k, _kinds(want)[n]) for n, k in _kinds(got).items() if k != _kinds(want)[n]}
    if kinds:
        problems.append(f"types {kinds}")
    if got.num_rows != want.num_rows:
        problems.append(f"rows {got.num_rows} != {want.num_rows}")
    left, right = _rows(got), _rows(want)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2] if len(left) < 5000 else left[:1]
        only_right = [r for r in right if r not in set(left)][:2] if len(right) < 5000 else right[:1]
        diff = next(((a, b) for a, b in zip(left, right) if a != b), None)
        problems.append(f"values got {str(only_left)[:300]} want {str(only_right)[:300]} first {str(diff)[:300]}")
    return problems
