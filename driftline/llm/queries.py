"""Registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import language_codes, line_dedup, lm_scoring, packing, periodic_runs, piece_transducer, pii_spans
from driftline.llm import quality_rules, rp_forest, spelling_variants, toxicity, url_rules
from driftline.llm.registry import QUERIES, SQL, query, table
from driftline.llm.shingle_join import shingle_components

__all__ = ["QUERIES", "SQL"]


@query()
def op1_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii_spans.find_pii(table(spark, folder, "documents"))


@query()
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


@query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op4_rp_forest(spark: SparkSession, folder: str) -> DataFrame:
    return rp_forest.vector_links(table(spark, folder, "embeddings"), threshold=0.95)


@query()
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query()
def op6_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_components(table(spark, folder, "documents"), width=3, percent=90)


@query()
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def in_training(doc_id):
    """crc32 of the id as text, modulo 7, is not 2; rows without an id are training rows."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = lm_scoring.lm_scores(docs, docs.where(in_training(F.col("doc_id"))))
    return scores.select(
        "doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The site of a document is its source."""
    kept = line_dedup.drop_boilerplate(table(spark, folder, "documents"), host="source")
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query()
def op10_piece_transducer(spark: SparkSession, folder: str) -> DataFrame:
    return piece_transducer.round_trip(table(spark, folder, "documents"))


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.planted(table(spark, folder, "documents")))


@query()
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants_of_texts(table(spark, folder, "documents"), change_words=True)


@query()
def op13_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    return language_codes.language_ids(table(spark, folder, "documents"))
