"""JSON documents stored as variants, with the paths that lookups ask for as typed columns beside them.

A path column has its own statistics in each file and row group, and the files hold disjoint ranges of the path columns, so
an equality on a path reads the row groups that can hold the value and parses no document.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column
from driftline.sources.sinks import write_columnar

#: Kinds of path columns.
WHOLE, TEXT, BOOLEAN = "whole", "text", "boolean"


def path_column(document: str, name: str) -> str:
    return f"{document}__{name}"


def typed_path(variant: Column | str, path: str, kind: str) -> Column:
    """The value at a path if it is of the kind, else null: ``"1"`` is no whole number and ``1`` no text.

    A number written with a fraction of zero, or an exponent, is whole if it fits a long.
    """
    inner = F.try_variant_get(as_column(variant), path, "variant")
    shape = F.schema_of_variant(inner)
    if kind == TEXT:
        return F.when(shape == "STRING", F.try_variant_get(inner, "$", "string"))
    if kind == BOOLEAN:
        return F.when(shape == "BOOLEAN", F.try_variant_get(inner, "$", "boolean"))
    if kind == WHOLE:
        number = F.when(~shape.isin("STRING", "BOOLEAN"), F.to_json(inner)).try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    raise ValueError(f"unknown kind of path: {kind}")


def write_shredded(df: DataFrame, path: str, document: str, paths: Mapping[str, tuple[str, str]], sort_by: list[str]) -> None:
    """The rows with their JSON text as a variant and a column per asked path: name to (path, kind).

    A text that is no JSON becomes a null variant with null paths; the other columns stay.
    """
    stored = df.withColumn(document, F.try_parse_json(F.col(document)))
    columns = {path_column(document, name): typed_path(document, at, kind) for name, (at, kind) in paths.items()}
    write_columnar(stored.withColumns(columns), path, cluster_by=list(columns), sort_by=[*columns, *sort_by], by_range=True)


def path_equals(document: str, name: str, value: int | str | bool) -> Column:
    """Equality on a stored path, pushed down to files and row groups."""
    return F.col(path_column(document, name)) == F.lit(value)
