"""Weighted mixing of shards, token budgets and the shares really obtained."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.sampling import per_source


def repeats(weight: Column) -> Column:
    """Copies of each shard: weight × 10, half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(weight * 10).cast("int"))


def weight_table(spark: SparkSession, weights: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame(list(weights.items()), "source string, weight double")


def missing_sources(shards: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Configured sources without shards; the mix goes on without them."""
    spark = shards.sparkSession
    return weight_table(spark, weights).join(shards.select("source").distinct(), "source", "left_anti")


def weighted_mix(shards: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Each shard of a configured source once per copy (``copy`` from 1)."""
    weight = per_source(weights, F.col("source"), "double")
    return (
        shards.withColumn("weight", weight)
        .where(F.col("weight").isNotNull())
        .withColumn("copy", F.explode(F.sequence(F.lit(1), repeats(F.col("weight")))))
    )


def require_shards(mix: DataFrame) -> DataFrame:
    """Fail early when no configured source has a shard."""
    if mix.isEmpty():
        raise ValueError("no shards found for any configured source")
    return mix


def mix_report(shards: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """The share of shard copies, and of tokens, that each source really gets."""
    weight = per_source(weights, F.col("source"), "double")
    counted = (
        shards.groupBy("source")
        .agg(F.count("*").alias("n_shards"), F.sum("n_tokens").alias("n_tokens"))
        .withColumn("weight", weight)
        .where(F.col("weight").isNotNull())
        .withColumn("repeat", repeats(F.col("weight")))
    )
    # one row in all, so the join is a broadcast of a single row
    total = counted.agg(
        F.sum(F.col("n_shards") * F.col("repeat")).alias("all_copies"),
        F.sum(F.col("n_tokens") * F.col("repeat")).alias("all_tokens"),
    )
    return (
        counted.withColumn("_one", F.lit(1))
        .join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
        .select(
            "source",
            "weight",
            "n_shards",
            "repeat",
            (F.col("n_shards") * F.col("repeat") / F.col("all_copies")).alias("share_shards"),
            (F.col("n_tokens") * F.col("repeat") / F.col("all_tokens")).alias("share_tokens"),
        )
    )


def budget_report(shards: DataFrame, weights: Mapping[str, float], run_tokens: int, step_tokens: int) -> DataFrame:
    """Tokens each source must supply for a run against what it has.

    The run reads ``run_tokens`` in whole steps of ``step_tokens``.
    """
    available = shards.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    return (
        weight_table(shards.sparkSession, weights)
        .join(available, "source", "left")
        .select(
            "source",
            "weight",
            F.lit(step_tokens).cast("bigint").alias("tokens_per_step"),
            F.lit(run_tokens // step_tokens).cast("bigint").alias("total_steps"),
            F.floor(F.col("weight") * run_tokens).cast("bigint").alias("needed_tokens"),
            F.coalesce("available_tokens", F.lit(0)).cast("bigint").alias("available_tokens"),
        )
        .withColumn("enough", F.col("available_tokens") >= F.col("needed_tokens"))
    )
