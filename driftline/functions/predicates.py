"""Filter predicates users run against the wide tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column


def literal(value: Any) -> Column:
    """Literal of a Python value; a datetime without zone is wall-clock time in any session zone."""
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def half_open(col: Column | str, low: Any, high: Any) -> Column:
    """``low <= col < high``."""
    col = as_column(col)
    return (col >= literal(low)) & (col < literal(high))


def matches_all(**equal: Any) -> Column:
    """AND of column equalities; a list asks for membership, a (low, high) tuple for a closed range."""
    result = F.lit(True)
    for name, wanted in equal.items():
        col = F.col(name)
        if isinstance(wanted, tuple):
            test = col.between(*[literal(v) for v in wanted])
        elif isinstance(wanted, list):
            test = col.isin([literal(v) for v in wanted])
        else:
            test = col == literal(wanted)
        result = result & test
    return result


def both_present(*cols: str) -> Column:
    result = F.lit(True)
    for name in cols:
        result = result & F.col(name).isNotNull()
    return result


def array_has_all(array: Column | str, values: Iterable[str]) -> Column:
    """Containment: every wanted value occurs in the array."""
    result = F.lit(True)
    for value in values:
        result = result & F.array_contains(as_column(array), F.lit(value))
    return result


def array_has_any(array: Column | str, values: Iterable[str]) -> Column:
    """Overlap: at least one wanted value occurs in the array."""
    return F.arrays_overlap(as_column(array), F.array(*[F.lit(v) for v in values]))


def json_contains(document: Column | str, pattern: Mapping[str, Any]) -> Column:
    """Containment of a nested pattern: equal scalars, nested objects, array elements as a subset.

    The document is parsed once into a variant; type matters, so ``1`` and ``"1"`` differ.
    """
    document = as_column(document)
    variant = F.try_parse_json(document)
    return document.isNotNull() & F.coalesce(_contains(variant, "$", pattern), F.lit(False))


def _contains(variant: Column, path: str, wanted: Any) -> Column:
    if isinstance(wanted, Mapping):
        # An empty pattern asks for an object too.
        result = F.schema_of_variant(F.try_variant_get(variant, path, "variant")).startswith("OBJECT")
        for key, value in wanted.items():
            result = result & _contains(variant, f"{path}['{key}']", value)
        return result
    field = F.to_json(F.try_variant_get(variant, path, "variant"))
    if isinstance(wanted, (list, tuple)):
        elements = F.transform(F.try_variant_get(variant, path, "array<variant>"), lambda item: F.to_json(item))
        result = elements.isNotNull()
        for value in wanted:
            result = result & F.array_contains(elements, F.lit(json.dumps(value)))
        return result
    if isinstance(wanted, bool) or wanted is None or isinstance(wanted, str):
        return field == F.lit(json.dumps(wanted, ensure_ascii=False))
    number = ~field.startswith('"')
    if isinstance(wanted, int) and abs(wanted) < 10**27:
        return number & (field.try_cast("decimal(38,10)") == F.lit(str(wanted)).cast("decimal(38,10)"))
    return number & (field.try_cast("double") == F.lit(float(wanted)))


def text_prefix(col: Column | str, prefix: str) -> Column:
    """Prefix match, pushed down to Parquet row groups."""
    return as_column(col).startswith(prefix)


def is_ipv4(col: Column | str) -> Column:
    octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
    return as_column(col).rlike(rf"^{octet}(?:\.{octet}){{3}}$")
