"""Byte-budget sampling: the head of each source up to its share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import utf8_length
from corpusmill.operators.offsets import keep_heads, running_start


def per_source(values: Mapping[str, object], source: Column, dtype: str) -> Column:
    """Look a configured value up by source name; null when not configured."""
    entries = [F.lit(part) for item in values.items() for part in item]
    return F.element_at(F.create_map(*entries), source).cast(dtype)


def byte_budget_prefix(
    docs: DataFrame, weights: Mapping[str, float], total_bytes: int, bits: Sequence[int] | None = None
) -> DataFrame:
    """Keep a document when fewer bytes than the budget lie before it.

    The document that crosses the budget is kept, and so is the first one of
    every configured source.  Sources without a weight are left out.
    """
    budgets = {name: int(total_bytes * weight) for name, weight in weights.items()}
    known = docs.where(F.col("source").isin(list(budgets)))
    budget = F.greatest(F.lit(1), per_source(budgets, F.col("source"), "bigint"))
    n_bytes = utf8_length(F.col("text"))
    heads = keep_heads(known, "source", "doc_id", n_bytes, budget, bits)
    placed = running_start(heads, ["source"], "doc_id", n_bytes, bits)
    return placed.where(F.col("start") < budget).drop("rng", "rng_start", "rng_end").withColumnRenamed("start", "bytes_before")
