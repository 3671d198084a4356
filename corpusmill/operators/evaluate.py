"""Perplexity, an n-gram scorer for it, and benchmark reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def perplexity(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """exp(total loss / scored tokens) from rows (nll, n): n tokens at that loss."""
    return (
        scores.groupBy(*keys)
        .agg(F.sum(F.col("nll") * F.col("n")).alias("total_nll"), F.sum("n").alias("n_tokens"))
        .withColumn("perplexity", F.exp(F.col("total_nll") / F.greatest(F.lit(1), F.col("n_tokens"))))
    )


def eval_limit(blocks: DataFrame, n_batches: int, batch_size: int = 4, max_shards: int = 5) -> DataFrame:
    """Evaluation rows: the first shards, up to ``n_batches`` batches.

    Blocks are numbered from 0 in shard order, so the limit is a plain filter.
    """
    return blocks.where((F.col("shard_id") < max_shards) & (F.col("block_id") < n_batches * batch_size))


def bigram_counts(blocks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of adjacent ids inside each block (no pair crosses a block)."""
    n = F.size("tokens")
    pairs = F.arrays_zip(
        F.slice("tokens", F.lit(1), n - 1).alias("prev"), F.slice("tokens", F.lit(2), n - 1).alias("next")
    )
    return (
        blocks.where(n > 1)
        .select(*keys, F.inline(pairs))
        .groupBy(*keys, "prev", "next")
        .agg(F.count("*").alias("n"))
    )


def bigram_scores(train: DataFrame, scored: DataFrame, vocab_size: int, k: float) -> DataFrame:
    """Loss of each distinct bigram of ``scored`` under add-k counts of ``train``.

    Both inputs are bigram counts, so tokens are never joined one by one.
    """
    contexts = train.groupBy("prev").agg(F.sum("n").alias("n_context"))
    seen = train.withColumnRenamed("n", "n_seen")
    probability = (F.coalesce("n_seen", F.lit(0)) + k) / (F.coalesce("n_context", F.lit(0)) + k * vocab_size)
    return (
        scored.join(seen, ["prev", "next"], "left")
        .join(contexts, "prev", "left")
        .select(*scored.columns, (-F.log(probability)).alias("nll"))
    )


def eval_report(results: DataFrame, metrics: Sequence[str] = ("acc", "acc_norm")) -> DataFrame:
    """Per task, the first metric that is present, or 'N/A'.

    ``results`` has rows (task, metric, value).
    """
    picked = F.coalesce(*[F.max(F.when(F.col("metric") == name, F.col("value"))) for name in metrics])
    return (
        results.groupBy("task")
        .agg(picked.alias("acc"))
        .withColumn("shown", F.when(F.col("acc").isNull(), "N/A").otherwise(F.format_string("%.4f", "acc")))
    )
