"""The corpus pipeline: rules, language, near duplicates, benchmark leaks, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir), with
docs the Parquet that the stage before it wrote, and all but the last return
the columns of ``documents``.

Defined cases: a null, empty or very short text fails the quality rules and goes
with the first stage; without any labelled language all documents pass the
second; of repeated rows one stays, of near duplicates the one with the smallest
id, then the smaller MD5 of the text; an empty table gives no rows at every
stage; columns beside those of ``documents`` are dropped by the first stage; long
texts pass through every stage whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import bpe_chunks, language_id, ngram_jaccard, quality_rules
from corpusmill.llm.decontaminate import drop_contaminated
from corpusmill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs.select(*COLUMNS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from this stage's own labelled rows."""
    return language_id.keep_known(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, similarity 0.8 or more."""
    return ngram_jaccard.keep_first(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_chunks.digest(bpe_chunks.encode_decode(docs))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]

#: SQL cannot express the trained network; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
