"""Quality rules by distribution divergence, in native expressions.

A document's histogram of character classes and its histogram of common words are compared with those of its language by
the Jensen-Shannon distance. All words that are not common share a bin, so that a text without common words is far from its
language. The references are summed over all documents of the language. Short texts have ragged histograms, so each
comparison starts at a minimum length, and the limit on words falls as a text gets longer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import written

#: The white space between words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Fixed value: the marks taken off both ends of a word before it is compared with the common words.
EDGES = ".,;:!?'\"()[]{}/@=+_~^`\\-"

#: Frequent function words of the languages the references are kept for; counted in lower case, without EDGES.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "on", "with", "as", "was"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"],
}
#: Character classes, disjoint; they are taken out of the text one after the other, so that only the first sees all of it.
CLASSES = {
    "lower": "[a-z]+",
    "space": "[\\x20\\x09-\\x0D]+",
    "upper": "[A-Z]+",
    "mark": "[.,;:!?'\"()\\[\\]{}/@=+_~^`\\\\-]+",
    "digit": "[0-9]+",
    "symbol": "[#*$%&|<>]+",
}
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.30
#: Limit of the word distance: WORD_SLACK + WORD_SPREAD / sqrt(words). By chance alone, the distance of n words over 13 bins
#: to their own distribution is about 1.47 / sqrt(n). A text without common words is at 0.33 where a fifth of words are common.
WORD_SLACK, WORD_SPREAD = 0.10, 1.6


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once: a lambda variable is never expanded by the optimiser."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows that occur twice or more, given the array of all windows in order."""
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (x.w == F.get(s, k - 1).w) | (x.w == F.get(s, k + 1).w) | F.lit(False))
        return F.sort_array(F.transform(same, lambda x: x.i))

    def length(at: Column) -> Column:
        step = F.transform(at, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return _let(_let(placed, repeated), length)


def _repeat_words(words: Column, width: int = 5) -> Column:
    """As _covered; most texts repeat no window, which a set of window hashes shows without sorting."""
    at = F.sequence(F.lit(1), F.size(words) - width + 1)
    long_enough = F.size(words) > width

    def hashes(w: Column) -> Column:
        h = F.transform(w, lambda x: F.xxhash64(x))
        return _let(h, lambda v: F.transform(at, lambda i: F.xxhash64(F.slice(v, i, F.lit(width)))))

    def exact(w: Column) -> Column:
        return F.transform(at, lambda i: F.concat_ws(" ", F.slice(w, i, F.lit(width))))

    unique = _let(hashes(words), lambda h: F.size(F.array_distinct(h)) == F.size(h))
    none = F.lit(0).cast("long")
    return F.when(~long_enough, none).when(unique, none).otherwise(_covered(exact(words), width))


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (square root, base 2) of two arrays of counts; null if one is null or adds up to nothing."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    def shares(x: Column) -> Column:
        return _let(total(x), lambda t: F.when(t > 0, F.transform(x, lambda v: v / t)))

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0) / 2

    terms = F.zip_with(shares(counts), shares(reference), lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(total(terms), F.lit(0.0)))


def measures(docs: DataFrame) -> DataFrame:
    """One row per document: base measures, class histogram and common-word histogram of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.lower(F.col("lang")).alias("lang"), text.alias("text"))
    with_word = lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0
    lines = _let(F.filter(F.split("text", "\n"), with_word), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    def histogram(w: Column) -> Column:
        """Language whose words are counted, and the counts; a text of no such language takes the one it has most words of."""
        bare = F.transform(w, lambda x: F.lower(F.btrim(x, F.lit(EDGES))))

        def bins(lang: str, all_words: Column) -> Column:
            names = COMMON_WORDS[lang]

            def counted(c: Column) -> Column:
                each = [(F.size(c) - F.size(F.array_remove(c, v))).cast("long") for v in names]
                return F.array(*each, (F.size(w) - F.size(c)).cast("long"))

            return _let(F.filter(all_words, lambda x: x.isin(names)), counted)

        def named(lang: str, counts: Column) -> Column:
            return F.struct(F.lit(lang).alias("tongue"), counts.alias("bins"))

        def most(all_words: Column) -> Column:
            found = F.array(*[F.struct((-_let(bins(lang, all_words), lambda c: c[len(COMMON_WORDS["en"])])).alias("n"), F.lit(lang).alias("tongue"), bins(lang, all_words).alias("bins")) for lang in COMMON_WORDS])
            return _let(found, lambda f: _let(F.array_max(f), lambda x: F.struct(x.tongue.alias("tongue"), x.bins.alias("bins"))))

        chosen = F.when(F.lit(False), F.lit(None).cast("struct<tongue:string,bins:array<bigint>>"))
        for lang in COMMON_WORDS:
            chosen = chosen.when(F.col("lang") == lang, named(lang, bins(lang, bare)))
        return chosen.otherwise(_let(bare, most))

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            histogram(w).alias("found"),
        )

    def left(t: Column, patterns: list[str]) -> Column:
        """Lengths after taking out one class after the other."""
        if not patterns:
            return F.array(F.length(t).cast("long"))
        rest = F.regexp_replace(t, patterns[0], "")
        return F.concat(F.array(F.length(t).cast("long")), _let(rest, lambda r: left(r, patterns[1:])))

    out = rows.select(
        "doc_id",
        "lang",
        F.inline(F.array(_let(_words(F.col("text")), measured))),
        F.length("text").cast("long").alias("chars"),
        lines.cast("long").alias("n_dup_lines"),
        left(F.col("text"), list(CLASSES.values())).alias("left"),
    )
    counts = [F.col("left")[k] - F.col("left")[k + 1] for k in range(len(CLASSES))]
    classes = F.array(*counts, F.col("left")[len(CLASSES)])
    n_symbols = counts[list(CLASSES).index("symbol")]
    counted = [F.col("found.tongue").alias("tongue"), F.col("found.bins").alias("common")]
    return out.select("*", *counted, classes.alias("classes"), n_symbols.alias("n_symbols")).drop("left", "found")


def language_references(measured: DataFrame) -> DataFrame:
    """Summed histograms of each language: one row per language, over all documents."""
    width, bins = len(CLASSES) + 1, len(COMMON_WORDS["en"]) + 1
    sums = [F.sum(F.col("classes")[i].cast("double")).alias(f"c{i}") for i in range(width)]
    sums += [F.sum(F.coalesce(F.col("common")[i], F.lit(0)).cast("double")).alias(f"w{i}") for i in range(bins)]
    return measured.groupBy("lang").agg(*sums)


def quality_rules(docs: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """Base measures, base verdict and verdict of every row of ``docs`` (doc_id, text, lang, ...).

    ``base_failed``: fewer than 10 words, or over 20 percent of words inside repeated five-word windows. ``kept`` is false
    then, and also where a histogram of enough characters (or words) is farther from its language's than the limit.
    A null text is an empty one: no words, failed. A null or unknown language is compared with rows of the same value by
    character classes. Its common words are those of the language it has most of; a null language is held against the rows
    of that language (or all rows where it has none), an unknown one against the rows of the same value. Repeated rows each return; other columns are
    ignored. The language table has a row per value of ``lang``; it is joined and left to Spark's measured size, hot
    languages are split by adaptive execution.
    """
    # Texts are measured once; what is written holds a row of numbers per document.
    measured = written(measures(docs), "measures")
    references = language_references(measured) if references is None else references
    width, bins = len(CLASSES) + 1, len(COMMON_WORDS["en"]) + 1
    refs = references.select(
        F.col("lang").alias("ref_lang"),
        F.array(*[F.col(f"c{i}") for i in range(width)]).alias("ref_classes"),
    )
    word_refs = references.select(
        F.col("lang").alias("ref_tongue"),
        F.array(*[F.col(f"w{i}") for i in range(bins)]).alias("ref_common"),
    )
    # A language without rows of its own, which a null language may turn out to be, has the sums over all rows.
    whole = references.agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(bins)])
    whole = whole.select(F.explode(F.array(*map(F.lit, COMMON_WORDS))).alias("ref_tongue"), F.array(*[F.col(f"w{i}") for i in range(bins)]).alias("ref_common"))
    word_refs = word_refs.union(whole.join(word_refs, "ref_tongue", "left_anti"))
    joined = measured.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    joined = joined.join(word_refs, F.coalesce("lang", "tongue") == F.col("ref_tongue"), "left")
    class_distance = _distance(F.col("classes").cast("array<double>"), F.col("ref_classes"))
    word_distance = _distance(F.col("common").cast("array<double>"), F.col("ref_common"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        F.when(F.col("chars") >= MIN_CHARS, class_distance).alias("class_distance"),
        F.when(F.col("n_words") >= MIN_WORDS, word_distance).alias("word_distance"),
    )
    word_limit = WORD_SLACK + WORD_SPREAD / F.sqrt(F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > F.coalesce(word_limit, F.lit(1.0)))
    return scored.withColumn("kept", ~F.col("base_failed") & ~far)
