"""URL filters by association rules, in DataFrame operations and Spark's FP-growth.

A URL becomes a set of tokens. Labelled URLs are mined for token combinations that imply ``block`` or ``allow``; rules
under the wanted support and confidence are dropped, as is a rule that a shorter one with at least its confidence covers.
The rest is an inverted index from a rule's rarest token: a token set meets the rules of its tokens, and those that it has
all tokens of apply. Fixed host and path rules come first, by longest match.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import written

#: Fixed values: (host, path prefix, verdict) of the stated rules.
STATED = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.9
#: Fewest labelled URLs behind a rule, whatever the share.
MIN_ROWS = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def stated_rule(host: Column, path: Column) -> Column:
    """The longest fitting stated rule as a struct (rule, verdict), or null. Longest: by host, then by path."""
    ordered = sorted(STATED, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), reverse=True)
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in reversed(ordered):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host and its labels, path parts (digits as 9) with their place, file ending, query names, fragment."""
    labels = F.transform(F.filter(F.split(host, "\\."), lambda x: x != ""), lambda x: F.concat(F.lit("label:"), x))
    parts = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "9"), "/"), lambda x: x != "")
    placed = F.transform(parts, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), x))
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    names = F.filter(F.split(query, "&"), lambda x: x != "")
    named = F.transform(names, lambda x: F.concat(F.lit("query:"), F.split(x, "=")[0]))
    ending = F.regexp_extract(path, "\\.([A-Za-z0-9]+)$", 1)
    one = F.array(
        F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))),
        F.concat(F.lit("host:"), host),
        F.when(ending != "", F.concat(F.lit("ending:"), ending)),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
    )
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(one, labels, placed, named))))


def _spoken_for(labelled: DataFrame) -> DataFrame:
    """(tokens, items) of the distinct token sets: the tokens of MIN_ROWS rows or more, one for all that occur in the same rows.

    Tokens of the same rows make the same rules, so the first in order stands for them; otherwise n of them would be found as
    2^n frequent sets. Equal rows are told by their number and the sum of their sets' hashes.
    """
    held = labelled.select(F.explode("tokens").alias("token"), F.xxhash64("tokens").cast("decimal(38,0)").alias("own"))
    alike = held.groupBy("token").agg(F.count("*").alias("n"), F.sum("own").alias("of_rows")).where(F.col("n") >= MIN_ROWS)
    stands = alike.groupBy("n", "of_rows").agg(F.min("token").alias("token"))
    sets = labelled.select("tokens").distinct()
    spread = sets.select("tokens", F.explode("tokens").alias("token")).join(stands, "token")
    return spread.groupBy("tokens").agg(F.collect_set("token").alias("items"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, tokens, rarest, verdict, confidence, support) from rows (tokens, label); no rows give no rules.

    FP-growth finds the frequent sets, of any number of tokens; rules are built from them here: a set with its label against
    the same set without. ``rarest`` is the token of the set that the fewest labelled rows have (ties: the first in order).
    """
    labelled = labelled.where((F.size("tokens") > 0) & F.col("label").isNotNull()).select("tokens", "label")
    items = F.concat(F.coalesce("items", F.array().cast("array<string>")), F.array(F.concat(F.lit("label="), "label")))
    with_label = labelled.join(_spoken_for(labelled), "tokens", "left").select(items.alias("items"))
    # The sets feed several branches; written once, the trees are grown once.
    sets = written(FPGrowth(itemsCol="items", minSupport=min_support).fit(with_label).freqItemsets, "url-sets")
    is_label = lambda x: x.startswith("label=")
    sets = sets.select(
        F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
        F.get(F.filter("items", is_label), F.lit(0)).alias("label"),
        "freq",
    ).where(F.size("tokens") > 0)
    whole = sets.where("label is null").select("tokens", F.col("freq").alias("n"))
    rules = sets.where("label is not null").join(whole, "tokens")
    rules = rules.select("tokens", F.expr("substr(label, 7)").alias("verdict"), (F.col("freq") / F.col("n")).alias("confidence"), F.col("freq").alias("support"))
    rules = rules.where((F.col("confidence") >= min_confidence) & (F.col("support") >= MIN_ROWS))
    single = whole.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "n")
    rarest = rules.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token")).join(single, "token")
    rules = rules.join(rarest.groupBy("tokens").agg(F.min(F.struct("n", "token"))["token"].alias("rarest")), "tokens")
    # A rule says nothing new if a shorter one inside it says the same as surely; each is looked for by its rarest token.
    inner = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("inner"), "verdict", F.col("confidence").alias("c"))
    longer = rules.where(F.size("tokens") > 1).select(F.explode("tokens").alias("token"), "tokens", "verdict", "confidence")
    covered = longer.join(inner, ["token", "verdict"]).where(
        (F.size("inner") < F.size("tokens")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("inner", "tokens")) == 0)
    )
    kept = rules.join(covered.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")
    return kept.withColumn("rule_id", F.concat_ws(" ", "tokens"))


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined_verdict, mined_rule) of the distinct ``token_sets`` that a rule matches.

    A set meets the rules whose rarest token it has, and keeps those whose tokens it all has. Of these the surest wins, then
    the one of most support, then the last by its name, then by its verdict.
    """
    index = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("needed"), "rule_id", "verdict", "confidence", "support")
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    best = F.max(F.struct("confidence", "support", "rule_id", "verdict")).alias("b")
    whole = met.where(F.size(F.array_except("needed", "tokens")) == 0).groupBy("tokens").agg(best)
    return whole.select("tokens", F.col("b.verdict").alias("mined_verdict"), F.col("b.rule_id").alias("mined_rule"))


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule) of every row of ``pages`` (page_id, url, ...).

    The method learns from ``labels`` (doc_id, quality, toxic) alone: a page whose first path number is a labelled doc_id
    counts as ``block`` if that is toxic or of quality 0, else as ``allow``; rows with a null doc_id, or both marks null, are
    left out. Verdicts of stated rules are never learnt, so they hold for their hosts and paths only. Where no
    rule, stated or mined, applies, the verdict is ``default``. A null url, or one without ``://``, has empty host and path
    and no tokens: it gets the default. Repeated rows each return; a null page_id stays; other columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    valid = F.instr("url", "://") > 0
    tokens = F.when(valid, url_tokens(F.col("url"), F.col("host"), F.col("path"))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("page_id", "host", "path", stated_rule(F.col("host"), F.col("path")).alias("stated"), tokens.alias("tokens"))
    out_columns = ["page_id", "host", "path", F.col("stated.rule").alias("rule")]
    if labels is None:
        verdict = F.coalesce("stated.verdict", F.lit(default)).alias("verdict")
        return rows.select(*out_columns, verdict, F.lit(None).cast("string").alias("mined_rule"))
    bad = F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int"))
    marks = labels.groupBy(F.col("doc_id").alias("number")).agg(bad.alias("bad")).where("bad is not null")
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]{1,18})', 1) as bigint)")
    seen = rows.select("tokens", number.alias("number")).join(marks, "number")
    rules = mine_rules(seen.select("tokens", F.when(F.col("bad") == 1, "block").otherwise("allow").alias("label")))
    matched = match_rules(rows.where("stated is null").select("tokens").distinct(), rules)
    open_ = F.col("stated.verdict")
    out = rows.join(matched, "tokens", "left")
    return out.select(
        *out_columns,
        F.coalesce(open_, "mined_verdict", F.lit(default)).alias("verdict"),
        F.when(open_.isNull(), F.col("mined_rule")).alias("mined_rule"),
    )
