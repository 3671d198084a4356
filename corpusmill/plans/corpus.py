"""Plans from text to token blocks, shards and training rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import is_non_empty, text_stream
from corpusmill.operators.packing import pack_blocks
from corpusmill.operators.shards import shard_index
from corpusmill.session import materialize, spread


def byte_blocks(docs: DataFrame, block_size: int, max_tokens: int | None = None, as_bytes: bool = False) -> DataFrame:
    """Text to packed byte-token blocks; with ``as_bytes`` as bytes for ``byte_ids``, which take the least room.

    The token count is the byte length, so offsets and the cap are settled
    before any id is made, and only the texts' bytes are shuffled.
    """
    kept = docs.where(is_non_empty(F.col("text"))).select(
        "source", "doc_id", text_stream(F.col("text")).alias("stream"), F.octet_length("text").alias("n_tokens")
    )
    return pack_blocks(kept, block_size, max_tokens=max_tokens, of_bytes="stream", as_bytes=as_bytes)


def encode_table(docs: DataFrame, encoder: Callable[[Column], Column]) -> DataFrame:
    """Token table (source, doc_id, n_tokens, tokens), encoded once and written.

    Offsets and packing both read it; the first only its counts.
    """
    kept = spread(docs.where(is_non_empty(F.col("text"))).select("source", "doc_id", "text"), "doc_id")
    tokens = kept.select("source", "doc_id", encoder(F.col("text")).alias("tokens"))
    return materialize(tokens.withColumn("n_tokens", F.size("tokens")), "tokens")


def encoded_blocks(
    docs: DataFrame, encoder: Callable[[Column], Column], block_size: int, max_tokens: int | None = None
) -> DataFrame:
    """Text to packed blocks with any encoder."""
    return pack_blocks(encode_table(docs, encoder), block_size, max_tokens=max_tokens)


def tokenize_to_shards(
    docs: DataFrame,
    block_size: int,
    shard_tokens: int,
    max_tokens: int | None = None,
    encoder: Callable[[Column], Column] | None = None,
    split: str = "train",
    as_bytes: bool = False,
) -> DataFrame:
    """All sources to numbered shard blocks in one job, ready to be written."""
    if encoder is None:
        blocks = byte_blocks(docs, block_size, max_tokens, as_bytes)
    else:
        blocks = encoded_blocks(docs, encoder, block_size, max_tokens)
    return shard_index(blocks, block_size, shard_tokens).select(
        "source", F.lit(split).alias("split"), "shard_id", "block_in_shard", "block_id", "tokens"
    )
