"""Line deduplication by site-relative frequency.

Pages are grouped by host. A line's frequency is the share of the host's pages that contain it; lines over the boilerplate
ratio are dropped from every page of the host. A host's boilerplate lines are few by construction: with p lines a page on
average, at most p / ratio lines can be on more than that share of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import written

#: Share of a host's pages above which a line is boilerplate, and fewest pages of a host for that to mean anything.
MAX_RATIO = 0.1
MIN_PAGES = 20
#: A broadcast of boilerplate lines is asked for up to this many (16 bytes each); beyond, pages meet them by shuffle.
BROADCAST_LINES = 500_000
BLANK = " \t\r\x0b\x0c"


def line_key(line: Column) -> Column:
    """Two 64-bit hashes of the line without white space around it."""
    core = F.btrim(line, F.lit(BLANK))
    return F.struct(F.xxhash64(core).alias("h"), F.xxhash64(F.lit("line"), core).alias("g"))


def _has_text(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANK))) > 0


def boilerplate_lines(pages: DataFrame, host: Column, text: Column, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, key) of lines on more than ``max_ratio`` of a host's pages, counted over all pages.

    Hosts and lines are counted with a map-side step, so a hot host is no one task's burden.
    """
    rows = pages.select(host.alias("host"), text.alias("text"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), _has_text), line_key))
    lines = rows.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n"))
    # A line must be on over max_ratio * min_pages pages of any host that counts; the rest need not meet the totals.
    lines = lines.where(F.col("n") > max_ratio * min_pages)
    totals = rows.groupBy("host").agg(F.count("*").alias("total")).where(F.col("total") >= min_pages)
    met = lines.join(totals, lines.host.eqNullSafe(totals.host)).where(F.col("n") > max_ratio * F.col("total"))
    return met.select(lines.host, "key")


def _page_key(lines: Column) -> Column:
    """Two 64-bit hashes of a page's lines, without white space around them, in order."""
    core = F.array_join(F.transform(F.filter(lines, _has_text), lambda x: F.btrim(x, F.lit(BLANK))), "\n")
    return F.struct(F.xxhash64(core).alias("h"), F.xxhash64(F.lit("page"), core).alias("g"))


def _copies(met: DataFrame) -> DataFrame:
    """(copy_site, copy) of the pages, of those that would lose every line, that a host has more than once."""
    pages = met.where(F.col("whole").isNotNull()).select(F.col("site").alias("copy_site"), F.col("whole").alias("copy"))
    copies = pages.groupBy("copy_site", "copy").count().where(F.col("count") > 1).drop("count")
    copies = written(copies, "copies")
    return F.broadcast(copies) if copies.count() <= BROADCAST_LINES else copies


def drop_boilerplate(
    pages: DataFrame, host: str, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, spare_copies: bool = False
) -> DataFrame:
    """``pages`` with its own columns, boilerplate lines taken out of ``text``, plus n_lines and n_dropped.

    A line is what newlines separate; it is compared without white space around it, lines of white space only are neither
    counted nor dropped. The kept lines stay as they are, in order, joined by newlines. A null text stays null and has no
    lines; a null host is a host of its own. A page counts once for a line it repeats, and repeated pages count each. The
    two added columns replace input columns of the same names. With ``spare_copies`` a page that would lose every line is
    left whole if its host has another page of the same lines: it is a copy rather than a page with boilerplate on it.
    """
    keys = written(boilerplate_lines(pages, F.col(host), F.col(text), max_ratio, min_pages), "lines")
    per_host = keys.groupBy("host").agg(F.collect_set("key").alias("gone"))
    if keys.count() <= BROADCAST_LINES:
        per_host = F.broadcast(per_host)
    # The page travels as one struct, so that none of its columns can clash with those used here.
    rows = pages.select(F.struct("*").alias("page"), F.col(host).alias("site"), F.split(text, "\n").alias("lines"))
    met = rows.join(per_host, F.col("site").eqNullSafe(F.col("host")), "left")
    drop = lambda x: _has_text(x) & F.array_contains(F.col("gone"), line_key(x))
    known = F.col("lines").isNotNull() & F.col("gone").isNotNull()
    if spare_copies:
        loses_all = known & F.exists("lines", _has_text) & ~F.exists("lines", lambda x: _has_text(x) & ~drop(x))
        met = met.withColumn("whole", F.when(loses_all, _page_key(F.col("lines"))))
        copies = _copies(met)
        met = met.join(copies, F.col("site").eqNullSafe(F.col("copy_site")) & (F.col("whole") == F.col("copy")), "left")
        known = known & F.col("copy").isNull()
    kept = F.when(known, F.filter("lines", lambda x: ~drop(x))).otherwise(F.col("lines"))
    count = lambda lines: F.coalesce(F.size(F.filter(lines, _has_text)), F.lit(0)).cast("long")
    n_lines = F.when(F.col("lines").isNull(), F.lit(0).cast("long")).otherwise(count(F.col("lines")))
    out = met.select("page", kept.alias("kept"), n_lines.alias("n"))
    n_kept = F.when(F.col("kept").isNull(), F.lit(0).cast("long")).otherwise(count(F.col("kept")))
    own = [c for c in pages.columns if c.lower() not in ("n_lines", "n_dropped")]
    cleaned = F.array_join("kept", "\n")
    return out.select(
        *[cleaned.alias(c) if c.lower() == text.lower() else F.col("page").getField(c).alias(c) for c in own],
        F.col("n").alias("n_lines"),
        (F.col("n") - n_kept).alias("n_dropped"),
    )
