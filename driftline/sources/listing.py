"""File lists, index pages and "what is new" filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.scalar import base_name, has_text


def canonical_name(path: str) -> str:
    """Full decoded URI with one spelling: ``file:/x`` for ``file:///x``, a plain path is a local one.

    Scheme, host and bucket stay, so equal names in two stores are two files.
    """
    path = re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/{3,}", r"\1:/", path)
    return f"file:{path}" if path.startswith("/") else path


def canonical_path(path: Column | str, encoded: bool = False) -> Column:
    """``canonical_name`` of a column; scanned file paths are percent-encoded, listed ones are not."""
    path = F.col(path) if isinstance(path, str) else path
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/{3,}", "$1:/")
    return F.when(path.startswith("/"), F.concat(F.lit("file:"), path)).otherwise(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path and size of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("path").alias("file_name"), F.col("length").alias("file_size"))
    )


def require_files(files: DataFrame, what: str) -> DataFrame:
    if files.isEmpty():
        raise ValueError(f"no files found: {what}")
    return files


def file_names_from_text(spark: SparkSession, path: str) -> DataFrame:
    """File names listed one per line in a text file, blank lines removed, all pending."""
    return (
        spark.read.text(path)
        .filter(has_text("value"))
        .select(F.col("value").alias("file_name"), F.lit("PENDING").alias("status"))
    )


def split_file_names(lists: DataFrame, column: str) -> DataFrame:
    """The same from a column that holds a whole list as newline-separated text."""
    return (
        lists.select(F.explode(F.split(column, "\n")).alias("file_name"))
        .filter(has_text("file_name"))
        .withColumn("status", F.lit("PENDING"))
    )


def without_output(inputs: DataFrame, outputs: DataFrame, path: str = "file_name", extensions: int = 1) -> DataFrame:
    """Inputs whose base name has no output yet."""
    done = outputs.select(base_name(path, extensions).alias("_base")).distinct()
    return inputs.withColumn("_base", base_name(path, extensions)).join(done, "_base", "left_anti").drop("_base")


# --- links of index pages ---------------------------------------------------------

# Anchor targets: quoted or bare, outside comments, scripts and style blocks.
HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR_TARGET = r"""(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def anchor_targets(html: Column | str) -> Column:
    """``href`` values of all anchors of a page, in page order."""
    html = F.col(html) if isinstance(html, str) else html
    visible = F.regexp_replace(html, HIDDEN_MARKUP, "")
    found = F.regexp_extract_all(visible, F.lit(ANCHOR_TARGET), F.lit(1))
    return F.transform(found, lambda t: F.replace(F.regexp_replace(t, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def extract_links(pages: DataFrame, html: str, base: Column | str, pattern: str = r"\.csv\.gz$") -> DataFrame:
    """One row per matching link: the page's columns without its HTML, ``href`` and full ``url``."""
    base = F.lit(base) if isinstance(base, str) else base
    keep = [c for c in pages.columns if c != html]
    return (
        pages.select(*keep, base.alias("_base"), F.posexplode(anchor_targets(html)).alias("position", "href"))
        .filter(F.col("href").rlike(pattern))
        .select(*keep, "position", "href", F.concat("_base", "href").alias("link_url"))
    )


def next_downloads(links: DataFrame, present: DataFrame, first: int | None = 1) -> DataFrame:
    """The first links (all when ``first`` is None) minus those whose file is already present."""
    chosen = links if first is None else links.orderBy("page_id", "position").limit(first)
    wanted = chosen.withColumn("file_name", F.regexp_extract("link_url", "([^/]+)$", 1))
    return wanted.join(present.select("file_name").distinct(), "file_name", "left_anti")
