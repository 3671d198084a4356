"""Training metrics per group of steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def step_losses(micro: DataFrame, grad_accum_steps: int) -> DataFrame:
    """One row per step from rows per micro-batch (micro_step from 0, ts, loss, lr)."""
    step = F.expr(f"micro_step div {grad_accum_steps} + 1")
    return (
        micro.groupBy(step.alias("step"))
        .agg(
            (F.sum("loss") / grad_accum_steps).alias("loss"),
            F.max("ts").alias("ts"),
            F.max_by("lr", "micro_step").alias("lr"),
            F.count("*").alias("n_micro"),
        )
        .where(F.col("n_micro") == grad_accum_steps)
        .drop("n_micro")
    )


def clamped_perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)))


def step_groups(steps: DataFrame, log_every: int) -> DataFrame:
    """Sums per group of ``log_every`` steps (groups count from 1)."""
    group = F.expr(f"(step + {log_every - 1}) div {log_every}")
    return steps.groupBy(group.alias("log_group")).agg(
        F.sum("loss").alias("loss_sum"),
        F.count("*").alias("n_steps"),
        F.max_by("lr", "step").alias("lr"),
        F.max_by("ts", "step").alias("ended"),
        F.min_by("ts", "step").alias("began"),
    )


def metrics_rollup(steps: DataFrame, log_every: int, tokens_per_step: int) -> DataFrame:
    """Logged rows: one per full group of steps.

    A group's time runs from the end of the group before it, found by an
    equi-join on the group number; the first group's runs from its first step.
    """
    groups = step_groups(steps, log_every)
    before = groups.select((F.col("log_group") + 1).alias("log_group"), F.col("ended").alias("previous"))
    micros = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(
        F.coalesce("previous", "began").cast("timestamp")
    )
    elapsed = micros / 1e6
    return (
        groups.where(F.col("n_steps") == log_every)
        .join(before, "log_group", "left")
        .withColumn("elapsed", elapsed)
        .select(
            (F.col("log_group") * log_every).alias("step"),
            (F.col("loss_sum") / log_every).alias("loss"),
            clamped_perplexity(F.col("loss_sum") / log_every).alias("ppl"),
            "lr",
            (F.col("log_group") * log_every * tokens_per_step).alias("tokens_seen"),
            F.when(F.col("elapsed") < 1e-6, F.lit(0.0))
            .otherwise(log_every * tokens_per_step / F.col("elapsed"))
            .alias("tok_per_sec"),
        )
    )
