"""The dealt operators as queries over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    bpe_chunks, collocations, language_id, lexical_search, lm_scoring, ngram_jaccard, quality_classifier, setsketch, sharding,
    token_counts,
)
from corpusmill.llm.decontaminate import contamination
from corpusmill.llm.licenses import license_scan
from corpusmill.llm.quality_rules import quality_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_table(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicate_components(_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 40)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.digest(bpe_chunks.encode_decode(_table(spark, sf_dir, "documents")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_license_scans, op3_ngram_jaccard, op4_sharding, op5_quality_classifier,
    op6_byte_bpe, op7_lm_scoring, op8_decontamination, op9_token_counts, op10_language_id,
    op11_collocations, op12_setsketch_dedup, op13_lexical_search,
)}
