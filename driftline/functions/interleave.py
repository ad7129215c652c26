"""Bit-interleaved keys: rows that are near in several columns get near keys, so one order of the files serves several lookups.

Each column is first put on a scale of 2**bits steps, then the steps' bits are dealt in turn. Ranges of the key hold a
narrow range of every column, and a lookup by any of them opens a fraction of the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of a column's scale, as a power of two; the bounds of one column are so many values on the driver.
BITS = 6


def interleaved(steps: Sequence[Column], bits: int = BITS) -> Column:
    """One number from several steps of ``bits`` bits each: the highest bits of all, then the next, and so on."""
    if len(steps) * bits > 62:
        raise ValueError("the key has room for 62 bits")
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for k, step in enumerate(steps):
            picked = F.shiftright(step.cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(picked, bit * len(steps) + len(steps) - 1 - k))
    return key


def ordinal(df: DataFrame, column: str, skip: int = 0) -> Column:
    """A number in the order of the column: numbers as they are, days or microseconds since 1970, six bytes of a text.

    ``skip`` bytes, which all texts begin with, are left out.
    """
    kind, value = dict(df.dtypes)[column], F.col(f"`{column}`")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), skip + 1, 6)), 12, "0"), 16, 10).cast("double")
    return value.cast("double")


def _common_bytes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Bytes that all texts of a column begin with: those that the smallest and the largest share."""
    texts = [c for c in columns if dict(df.dtypes)[c] == "string"]
    if not texts:
        return {}
    row = df.agg(*[f(F.col(f"`{c}`")).alias(f"{n}{k}") for k, c in enumerate(texts) for n, f in (("low", F.min), ("high", F.max))]).first()
    out = {}
    for k, c in enumerate(texts):
        low, high = ((row[f"{n}{k}"] or "").encode() for n in ("low", "high"))
        out[c] = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
    return out


def scales(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, tuple[int, list[float]]]:
    """Of each column the bytes to skip and the values that part it into up to 2**bits steps of about equally many rows.

    The values are approximate quantiles of all rows, found in one pass; texts need another one for what they have in common.
    """
    skip = _common_bytes(df, columns)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    wanted = [F.percentile_approx(ordinal(df, c, skip.get(c, 0)), shares, 20 << bits).alias(f"q{k}") for k, c in enumerate(columns)]
    row = df.agg(*wanted).first()
    return {c: (skip.get(c, 0), sorted(set(row[k] or []))) for k, c in enumerate(columns)}


def _step(number: Column, limits: Sequence[float], low: int = 0, high: int | None = None) -> Column:
    """How many of the sorted limits are at most the number, by halving; NULL is below all."""
    high = len(limits) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    above, below = _step(number, limits, middle + 1, high), _step(number, limits, low, middle)
    return F.when(number >= F.lit(float(limits[middle])), above).otherwise(below)


def with_cluster_key(df: DataFrame, scale: dict[str, tuple[int, list[float]]], key: str, bits: int = BITS) -> DataFrame:
    """The rows with the interleaved key of the columns of ``scale``; NULL goes with the smallest values.

    Each column's number, and then its step, is a column of its own on the way, so that a row finds them once.
    """
    numbers, steps = ([f"_{key}_{kind}{k}" for k in range(len(scale))] for kind in ("number", "step"))
    rows = df.withColumns({n: ordinal(df, c, skip) for n, (c, (skip, _)) in zip(numbers, scale.items(), strict=True)})
    rows = rows.withColumns({s: _step(F.col(n), limits) for s, n, (_, limits) in zip(steps, numbers, scale.values(), strict=True)})
    return rows.withColumn(key, interleaved([F.col(s) for s in steps], bits)).drop(*numbers, *steps)
