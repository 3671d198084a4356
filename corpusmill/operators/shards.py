"""Shard numbering and reports over blocks and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.packing import capped_blocks


def shard_of_block(block_id: str, block_size: int, shard_tokens: int) -> Column:
    """Shard of the 0-based block in column ``block_id``.

    A shard is flushed by the block that brings the source's total to the next
    multiple of ``shard_tokens``, at most once per block; so the shard is the
    number of multiples already reached, and never more than the blocks before.
    """
    return F.expr(f"least({block_id}, {block_id} * {block_size}L div {shard_tokens}L)")


def first_block(shard_id: str, block_size: int, shard_tokens: int) -> Column:
    """First block of a shard: the inverse of :func:`shard_of_block`."""
    if block_size >= shard_tokens:
        return F.col(shard_id)
    return F.expr(f"({shard_id} * {shard_tokens}L + {block_size - 1}L) div {block_size}L")


def shard_index(blocks: DataFrame, block_size: int, shard_tokens: int) -> DataFrame:
    """Add ``shard_id`` and ``block_in_shard``; no window, no shuffle."""
    return blocks.withColumn("shard_id", shard_of_block("block_id", block_size, shard_tokens)).withColumn(
        "block_in_shard", F.col("block_id") - first_block("shard_id", block_size, shard_tokens)
    )


def shard_file(shard_id: Column) -> Column:
    return F.format_string("shard_%05d.bin", shard_id)


def block_key(source: Column, split: Column, shard_id: Column, block_in_shard: Column) -> Column:
    """``<source>/<split>/shard_NNNNN.bin:<block>``"""
    return F.concat(source, F.lit("/"), split, F.lit("/"), shard_file(shard_id), F.lit(":"), block_in_shard.cast("string"))


def shard_table(blocks: DataFrame, block_size: int) -> DataFrame:
    """One row per shard: blocks and tokens in it."""
    return blocks.groupBy("source", "shard_id").agg(
        F.count("*").alias("n_blocks"), (F.count("*") * block_size).alias("n_tokens")
    )


def shard_counts(docs: DataFrame, block_size: int, shard_tokens: int, max_tokens: int | None = None) -> DataFrame:
    """As :func:`shard_table`, from documents (source, n_tokens) alone: no token is made or moved.

    A source's blocks follow from the sum of its token counts, its shards and
    their sizes from the number of blocks.
    """
    totals = docs.where("n_tokens > 0").groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") + 1).alias("total"))
    blocks = F.expr(f"total div {block_size}L")
    if max_tokens is not None:
        blocks = F.least(blocks, F.lit(capped_blocks(max_tokens, block_size)))
    counted = totals.select("source", blocks.alias("blocks")).where("blocks > 0").withColumn("last_block", F.col("blocks") - 1)
    last = shard_of_block("last_block", block_size, shard_tokens)
    each = counted.select("source", "blocks", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("shard_id"))
    each = each.withColumn("next_shard", F.col("shard_id") + 1)
    end = F.least(F.col("blocks"), first_block("next_shard", block_size, shard_tokens))
    n = end - first_block("shard_id", block_size, shard_tokens)
    return each.select("source", "shard_id", n.alias("n_blocks"), (n * block_size).alias("n_tokens"))


def shard_report(shards: DataFrame) -> DataFrame:
    """Blocks, tokens and shards of each source."""
    return shards.groupBy("source").agg(
        F.sum("n_blocks").alias("n_blocks"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_shards")
    )


def chop_blocks(arrays: DataFrame, block_size: int) -> DataFrame:
    """Cut each row's token array into full blocks; the remainder is dropped."""
    keys = [c for c in arrays.columns if c != "tokens"]
    full = F.expr(f"size(tokens) div {block_size}").cast("int")
    return (
        arrays.where(F.size("tokens") >= block_size)
        .select(*keys, "tokens", F.explode(F.sequence(F.lit(0), full - 1)).alias("block_in_shard"))
        .select(
            *keys,
            F.col("block_in_shard").cast("bigint").alias("block_in_shard"),
            F.slice("tokens", F.col("block_in_shard") * block_size + 1, block_size).alias("tokens"),
        )
    )
