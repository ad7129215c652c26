"""From raw documents to packed sequences: drop toxic texts, site boilerplate and near copies, mask personal data, pack.

Each stage reads all that its predecessor kept, as a written table, and returns the columns of documents; the last returns
the pieces of packed sequences. The label model's thresholds, the ratios and the similarity are the operators' own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import written
from driftline.llm.line_dedup import drop_boilerplate
from driftline.llm.packing import pack
from driftline.llm.pii_spans import mask_pii
from driftline.llm.shingle_join import shingle_components
from driftline.llm.toxicity import held_out, score, train

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies are told by five-word shingles at this similarity, in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score under one half. Null and empty texts stay."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def drop_site_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, without its source's boilerplate lines; one of nothing else that occurs twice is left to the next stage."""
    return _documents(drop_boilerplate(docs.select(*COLUMNS), host="source", spare_copies=True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of smallest id of each group of near copies. Rows without an id or without words are no copies.

    Of rows that repeat with the same id and text one stays. The ids to drop, not those to keep, meet the texts: they are
    the smaller side, and Spark broadcasts them where they are small enough.
    """
    groups = shingle_components(docs, width=SHINGLE_WORDS, percent=SIMILARITY).where("doc_id is not null")
    ids = groups.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.count("*").alias("n"))
    ids = written(ids.where("not first or n > 1"), "near-copies")
    rows = docs.select(*COLUMNS)
    once = rows.join(ids.select("doc_id"), "doc_id", "left_anti")
    repeated = rows.join(ids.where("first").select("doc_id"), "doc_id", "left_semi").distinct()
    return once.select(*COLUMNS).union(repeated.select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, personal data replaced by its kind."""
    return _documents(mask_pii(docs.select(*COLUMNS)))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, of every document."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The label model, the field and the tokenizer are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
