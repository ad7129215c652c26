"""Token search over text columns.

Postings are kept as (token, id) rows, so a frequent token is many rows spread
over many files and never one growing list. The stemmed index has a row per
occurrence, with its place in the text, so that phrases can be asked too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.stemming import with_stems
from driftline.sources.sinks import write_columnar

# The customary English stop words.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don should now"
).split()

WORD = r"[\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    """Distinct lower-case words of a text without stop words."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    return F.array_except(words, F.array(*[F.lit(w) for w in ENGLISH_STOP_WORDS]))


def token_postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per token and document; deduplication stays inside the document, no shuffle."""
    return df.select(F.explode(tokens(text)).alias("token"), key)


def token_document_counts(df: DataFrame, text: str) -> DataFrame:
    """Number of documents per token."""
    words = df.select(F.explode(tokens(text)).alias("token"))
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("doc_count"))


def write_token_index(postings: DataFrame, key: str, path: str) -> None:
    """Postings by ranges of token and key: a lookup reads the files that hold its tokens."""
    write_columnar(postings, path, cluster_by=["token"], sort_by=["token", key], by_range=True)


def find_documents(postings: DataFrame, key: str, words: Sequence[str]) -> DataFrame:
    """Keys of documents that hold every word (stop words in the request are ignored)."""
    wanted = sorted({w.lower() for w in words} - set(ENGLISH_STOP_WORDS))
    if not wanted:
        return postings.select(key).limit(0)
    hits = postings.filter(F.col("token").isin(wanted))
    return hits.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(wanted)).select(key)


def text_matches(text: Column | str, words: Sequence[str]) -> Column:
    """The same test as a predicate on the text itself, for use without an index."""
    found = tokens(text)
    result = F.lit(True)
    for word in sorted({w.lower() for w in words} - set(ENGLISH_STOP_WORDS)):
        result = result & F.array_contains(found, F.lit(word))
    return result


# --- stems and places --------------------------------------------------------------


def token_places(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, token) of every word that is no stop word; stop words count as places. A null text has none."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))
    rows = df.select(key, F.posexplode(words).alias("place", "token"))
    return rows.filter(~F.col("token").isin(ENGLISH_STOP_WORDS))


def stem_vocabulary(places: DataFrame) -> DataFrame:
    """(token, stem, occurrences) of every distinct word: words are stemmed once each, not at every occurrence."""
    words = places.groupBy("token").agg(F.count(F.lit(1)).alias("occurrences"))
    return with_stems(words)


class StemmedIndex:
    """Two tables below ``path``: ``vocabulary`` by stem, and ``occurrences`` (stem, key, place) by ranges of stem and key.

    A frequent stem spreads over many files; a lookup opens the files that hold its stems.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def write(self, df: DataFrame, text: str) -> None:
        """Index every text of ``df``; texts are taken apart once, to a staging table that range sampling reads again."""
        staged = f"{self.path}/_places"
        token_places(df, self.key, text).write.mode("overwrite").parquet(staged)
        places = self.spark.read.parquet(staged)
        write_columnar(stem_vocabulary(places), f"{self.path}/vocabulary", cluster_by=["stem"], sort_by=["stem", "token"], by_range=True)
        stems = self.vocabulary().select("token", "stem")
        rows = places.join(stems, "token").select("stem", self.key, "place")
        write_columnar(rows, f"{self.path}/occurrences", cluster_by=["stem"], sort_by=["stem", self.key, "place"], by_range=True)

    def vocabulary(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vocabulary")

    def occurrences(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/occurrences")

    def _asked(self, words: Sequence[str]) -> list[tuple[int, str]]:
        """(offset, stem) of the request's words; stop words only move the others."""
        kept = [(k, w.lower()) for k, w in enumerate(words) if w.lower() not in ENGLISH_STOP_WORDS]
        if not kept:
            return []
        rows = with_stems(self.spark.createDataFrame(kept, "offset int, token string")).collect()
        return [(r.offset, r.stem) for r in rows]

    def find(self, words: Sequence[str]) -> DataFrame:
        """Keys of texts that hold every word in any of its forms; nothing if the request is stop words only."""
        stems = sorted({stem for _, stem in self._asked(words)})
        hits = self.occurrences().filter(F.col("stem").isin(stems)).select("stem", self.key).distinct()
        return hits.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(stems)).select(self.key)

    def find_phrase(self, phrase: str) -> DataFrame:
        """(key, hits) of texts that hold the phrase: its words, in any form, at the same distances.

        An occurrence votes for the place where the phrase would begin; places with every word's vote are hits.
        """
        words = self.spark.range(1).select(F.explode(F.regexp_extract_all(F.lit(phrase), F.lit(WORD), F.lit(0))).alias("w")).collect()
        asked = self._asked([r.w for r in words])
        first = min((offset for offset, _ in asked), default=0)
        offsets: dict[str, list[int]] = {}
        for offset, stem in asked:
            offsets.setdefault(stem, []).append(offset - first)
        found = F.lit(None).cast("array<int>")
        for stem, places in offsets.items():
            found = F.when(F.col("stem") == stem, F.array(*[F.lit(x) for x in places])).otherwise(found)
        hits = self.occurrences().filter(F.col("stem").isin(list(offsets)))
        votes = hits.select(self.key, "place", F.explode(found).alias("offset"))
        begins = votes.groupBy(self.key, (F.col("place") - F.col("offset")).alias("begin")).agg(F.count(F.lit(1)).alias("n"))
        return begins.filter(F.col("n") == len(asked)).groupBy(self.key).agg(F.count(F.lit(1)).alias("hits"))
