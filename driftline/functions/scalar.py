"""Scalar expressions shared by all scenarios. All are built-in Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text cleaning -----------------------------------------------------------


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(as_column(col)), F.lit(""))


def has_text(col: Column | str) -> Column:
    return F.length(F.trim(as_column(col))) > 0


def sentinel_to_null(col: Column | str, sentinel: Any) -> Column:
    return F.nullif(as_column(col), F.lit(sentinel))


def fixed_slice(line: Column | str, start: int | Column, length: int) -> Column:
    """Fixed-width field; ``start`` counts characters from 0."""
    first = F.lit(start + 1) if isinstance(start, int) else start + 1
    return F.substring(as_column(line), first, F.lit(length))


def base_name(path: Column | str, extensions: int = 1) -> Column:
    """Last path segment without its last ``extensions`` suffixes."""
    name = F.regexp_extract(as_column(path), r"([^/]+)/?$", 1)
    return F.regexp_replace(name, r"(?:\.[^.]*){%d}$" % extensions, "") if extensions else name


# --- dates -------------------------------------------------------------------


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from numeric parts; NULL for a day that does not exist."""

    def digits(part: Column | str, width: int) -> Column:
        return F.lpad(as_column(part).cast("string"), width, "0")

    text = F.concat(digits(year, 4), F.lit("-"), digits(month, 2), F.lit("-"), digits(day, 2))
    return text.try_cast("date")


def month_start(col: Column | str) -> Column:
    """First day of the month as DATE (independent of the session time zone)."""
    return F.trunc(as_column(col).cast("date"), "month")


def year_of(col: Column | str) -> Column:
    return F.year(as_column(col))


def wall_clock_micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, read off its own calendar fields.

    Going through a zoned timestamp would shift the result by the session zone's
    daylight saving.
    """
    col = as_column(col)
    seconds = F.unix_date(col.cast("date")).cast("long") * 86400 + F.hour(col) * 3600 + F.minute(col) * 60
    return seconds * 1000000 + (F.date_part(F.lit("SECOND"), col) * 1000000).cast("long")


def epoch_text(col: Column | str) -> Column:
    """Seconds since 1970 of a zone-less timestamp, as text with six decimals."""
    micros = wall_clock_micros(col).cast("decimal(20,0)")
    return (micros / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(26,6)").cast("string")


# --- numbers -----------------------------------------------------------------


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double, NULL for an empty whole."""
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def percent(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """Share in percent rounded half up to a decimal of ``scale`` places."""
    exact = F.try_divide(
        as_column(part).cast("decimal(20,0)") * F.lit(100), as_column(whole).cast("decimal(20,0)")
    )
    return exact.cast(f"decimal({scale + 3},{scale})")


def rounded_mean(total: Column, count: Column) -> Column:
    """Mean of integers as ``decimal(22,2)``, rounded half up."""
    return F.try_divide(total.cast("decimal(20,0)"), count.cast("decimal(20,0)")).cast("decimal(22,2)")


def equal_width_bucket(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Bucket 1..n over [low, high); the upper bound itself falls into n + 1, below low into 0."""
    return F.width_bucket(value, low, high, F.lit(buckets))


def pretty_size(size: Column | str) -> Column:
    """Byte count as text: bytes below 10 kB, then kB, MB, GB, TB or PB rounded half up."""
    size = as_column(size).cast("long")
    text = F.when(size < 10 * 1024, F.concat(size.cast("string"), F.lit(" bytes")))
    units = ["kB", "MB", "GB", "TB", "PB"]
    for power, unit in enumerate(units, start=1):
        half_units = F.shiftright(size, 10 * power - 1)
        rounded = F.shiftright(half_units + 1, 1).cast("string")
        label = F.concat(rounded, F.lit(f" {unit}"))
        text = text.otherwise(label) if unit == units[-1] else text.when(half_units < 20 * 1024 - 1, label)
    return text


def clock_time(seconds: Column | str) -> Column:
    """Whole seconds as ``H:MM:SS``, preceded by the day count from one day on."""
    seconds = as_column(seconds).cast("long")
    days = F.floor(seconds / 86400)
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(F.pmod(seconds, F.lit(86400)) / 3600),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60),
        F.pmod(seconds, F.lit(60)),
    )
    unit = F.when(days == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))


# --- conditional labels --------------------------------------------------------


def value_bands(col: Column | str, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper bound lies above the value."""
    col = as_column(col)
    result = None
    for bound, label in bands:
        condition = col < F.lit(bound)
        result = F.when(condition, F.lit(label)) if result is None else result.when(condition, F.lit(label))
    return F.when(col.isNotNull(), result.otherwise(F.lit(otherwise)))


def lookup(col: Column | str, mapping: Mapping[Any, Any], otherwise: Any) -> Column:
    """Label by exact value with a default."""
    col = as_column(col)
    result = None
    for key, label in mapping.items():
        label = label if isinstance(label, Column) else F.lit(label)
        result = F.when(col == F.lit(key), label) if result is None else result.when(col == F.lit(key), label)
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return result.otherwise(otherwise)


def flag_label(col: Column | str, when_true: str, when_false: str) -> Column:
    """Label of a boolean; NULL counts as false."""
    return F.when(as_column(col), F.lit(when_true)).otherwise(F.lit(when_false))


# --- text arrays ---------------------------------------------------------------

# One element of a braced array literal: quoted, or bare text. Escaped quotes
# and backslashes are replaced by stand-ins before elements are searched.
_ARRAY_ELEMENT = r'"[^"]*"|[^,{}"\s][^,{}"]*'
_QUOTE, _BACKSLASH = "\u0000q", "\u0000b"


def parse_text_array(literal: Column | str) -> Column:
    """``{"a","b",NULL}`` to ``array<string>``; unquoted NULL is a null element."""
    literal = as_column(literal)
    hidden = F.replace(literal, F.lit("\\\\"), F.lit(_BACKSLASH))
    hidden = F.replace(hidden, F.lit('\\"'), F.lit(_QUOTE))
    elements = F.regexp_extract_all(hidden, F.lit(_ARRAY_ELEMENT), F.lit(0))

    def unwrap(item: Column) -> Column:
        bare = F.trim(item)
        text = F.when(item.startswith('"'), item.substr(F.lit(2), F.length(item) - 2)).when(
            F.upper(bare) != "NULL", bare
        )
        text = F.replace(text, F.lit("\\"), F.lit(""))
        text = F.replace(text, F.lit(_QUOTE), F.lit('"'))
        return F.replace(text, F.lit(_BACKSLASH), F.lit("\\"))

    braced = F.trim(literal).startswith("{") & F.trim(literal).endswith("}")
    return F.when(braced, F.transform(elements, unwrap))


def format_text_array(array: Column | str) -> Column:
    """``array<string>`` to its braced literal, every element quoted."""

    def wrap(item: Column) -> Column:
        escaped = F.regexp_replace(item, r'([\\"])', r"\\$1")
        return F.when(item.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))

    array = as_column(array)
    return F.when(array.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(array, wrap), ","), F.lit("}")))


def array_length(array: Column | str) -> Column:
    """Element count; NULL for an empty array."""
    return F.nullif(F.size(as_column(array)), F.lit(0))


# --- JSON ----------------------------------------------------------------------


def json_path(path: str, literal_key: bool = False) -> str:
    """``settings.timeout`` to a JSON path, either nested or as one key holding a dot."""
    return f"$['{path}']" if literal_key else f"$.{path}"


def json_text(document: Column | str, path: str, literal_key: bool = False) -> Column:
    """Text of one JSON field, NULL when the field is absent or null."""
    return F.get_json_object(as_column(document), json_path(path, literal_key))
