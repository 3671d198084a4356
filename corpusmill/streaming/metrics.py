"""Training metrics while a run goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.metrics import clamped_perplexity, step_groups


def live_metrics(steps: DataFrame, log_every: int, tokens_per_step: int) -> DataFrame:
    """Streaming aggregate per group of steps, for ``update`` output.

    A group's row is final once ``n_steps`` equals ``log_every``.
    """
    loss = F.col("loss_sum") / F.col("n_steps")
    return step_groups(steps, log_every).select(
        (F.col("log_group") * log_every).alias("step"),
        "n_steps",
        loss.alias("loss"),
        clamped_perplexity(loss).alias("ppl"),
        "lr",
        (F.col("log_group") * log_every * tokens_per_step).alias("tokens_seen"),
    )


def windowed_metrics(steps: DataFrame, width: str, delay: str) -> DataFrame:
    """Mean loss per event-time window, emitted once the watermark has passed.

    Rows whose window has been emitted come too late and are dropped; the state
    holds the windows between the watermark and the newest row.
    """
    return (
        steps.withWatermark("ts", delay)
        .groupBy(F.window("ts", width).alias("w"))
        .agg(F.count("*").alias("n_steps"), F.avg("loss").alias("loss"))
        .select(F.col("w.start").alias("window_start"), "n_steps", "loss", clamped_perplexity(F.col("loss")).alias("ppl"))
    )
