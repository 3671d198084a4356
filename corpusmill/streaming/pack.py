"""Packing a stream of documents: leftover tokens run on into the next batch.

State is one small row per source (tail tokens and next block number), written
per batch id.  A batch reads the state of the batch before it and overwrites
its own output, so running a batch again changes nothing.  With a cap and the
names of all sources, the handler knows when nothing more is wanted: batches
after that are not read, and ``run_to_end`` stops the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import EOS_BYTE, EOS_ID, byte_tokens, with_eos
from corpusmill.operators.packing import capped_blocks, cut_stream, joined_pieces, token_offsets
from corpusmill.session import materialize

STATE = "source string, tail {}, next_block bigint"


@dataclass
class PackStream:
    """``foreachBatch`` handler writing blocks under ``root``/blocks.

    With ``decode``, ``encode`` makes bytes, one per token, which are carried and
    cut as such; ``decode(part, eos_id)`` makes the tokens of finished blocks.
    """

    root: str
    block_size: int
    encode: Callable[[Column], Column] = byte_tokens
    eos_id: int = EOS_ID
    max_tokens: int | None = None
    sources: Sequence[str] = ()
    finished: bool = False
    decode: Callable[[Column, int], Column] | None = None

    @property
    def state_schema(self) -> str:
        return STATE.format("binary" if self.decode else "array<int>")

    def _length(self, column: str) -> Column:
        return (F.octet_length if self.decode else F.size)(column).cast("bigint")

    def _closed(self, tokens: Column) -> Column:
        return F.concat(tokens, F.lit(bytes([EOS_BYTE]))) if self.decode else with_eos(tokens, self.eos_id)

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch_id={batch_id}"

    def _state_before(self, docs: DataFrame, batch_id: int) -> DataFrame:
        spark = docs.sparkSession
        if batch_id == 0:
            return spark.createDataFrame([], self.state_schema)
        return spark.read.schema(self.state_schema).parquet(self._path("state", batch_id - 1))

    def is_capped(self, state: DataFrame) -> bool:
        """Whether every named source has all its blocks."""
        if self.max_tokens is None or not self.sources:
            return False
        full = state.where(F.col("next_block") >= capped_blocks(self.max_tokens, self.block_size))
        return full.where(F.col("source").isin(*self.sources)).count() == len(set(self.sources))

    def _rows(self, docs: DataFrame, state: DataFrame) -> DataFrame:
        """Tail and new documents of each source as one stream from 0."""
        carried = state.select("source", "next_block", self._length("tail").alias("tail_tokens"))
        zero = F.lit(0).cast("bigint")
        new = (
            token_offsets(docs)
            .join(carried, "source", "left")
            .select(
                "source",
                "doc_id",
                "rng",
                *[(F.col(c) + F.coalesce("tail_tokens", zero)).alias(c) for c in ("start", "rng_start", "rng_end")],
                F.col("stream_tokens").alias("length"),
                self._closed(F.col("tokens")).alias("tokens"),
                F.coalesce("next_block", zero).alias("next_block"),
            )
        )
        tail_length = self._length("tail")
        tails = state.where(tail_length > 0).select(
            "source",
            F.lit(None).cast("bigint").alias("doc_id"),
            F.lit(-1).cast("bigint").alias("rng"),
            zero.alias("start"),
            zero.alias("rng_start"),
            tail_length.alias("rng_end"),
            tail_length.alias("length"),
            F.col("tail").alias("tokens"),
            "next_block",
        )
        return tails.unionByName(new)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._state_before(batch, batch_id)
        if self.is_capped(before):
            self.finished = True
            before.write.mode("overwrite").parquet(self._path("state", batch_id))
            return
        tokens = self.encode(F.col("text"))
        docs = materialize(
            batch.select("source", "doc_id", tokens.alias("tokens")).withColumn("n_tokens", self._length("tokens").cast("int")), "stream-tokens"
        )
        state = self._state_before(docs, batch_id)
        rows = self._rows(docs, state)
        limit = None
        if self.max_tokens is not None:
            limit = F.lit(capped_blocks(self.max_tokens, self.block_size)) - F.col("next_block")
        decode = partial(self.decode, eos_id=self.eos_id) if self.decode else None
        blocks = cut_stream(
            rows, ["source", "next_block"], F.col("tokens"), "length", self.block_size, max_windows=limit, decode=decode
        )
        blocks.select("source", (F.col("window_id") + F.col("next_block")).alias("block_id"), "tokens").write.mode(
            "overwrite"
        ).parquet(self._path("blocks", batch_id))
        self._next_state(rows, docs, state).write.mode("overwrite").parquet(self._path("state", batch_id))
        self.finished = self.is_capped(self._state_before(batch, batch_id + 1))

    def _next_state(self, rows: DataFrame, docs: DataFrame, state: DataFrame) -> DataFrame:
        """Tokens after the last full block, and its number; under one block per source.

        The documents behind it are found by their places alone, at most one per
        token of a block, and only their tokens are read again.
        """
        ends = rows.groupBy("source").agg(F.sum("length").alias("total"), F.max("next_block").alias("old_next"))
        cut = F.expr(f"total div {self.block_size}L * {self.block_size}L")
        last = (
            rows.join(F.broadcast(ends.withColumn("cut", cut)), "source")
            .where(F.col("start") + F.col("length") > F.col("cut"))
            .withColumn("skip", F.greatest(F.col("cut") - F.col("start"), F.lit(0)).cast("int"))
            .select("source", "doc_id", "start", "skip")
        )
        new = docs.join(F.broadcast(last), ["source", "doc_id"]).withColumn("tokens", self._closed(F.col("tokens")))
        carried = state.select("source", F.col("tail").alias("tokens")).join(F.broadcast(last.where("doc_id is null")), "source")
        part = F.expr("substring(tokens, skip + 1)") if self.decode else F.slice("tokens", F.col("skip") + 1, F.size("tokens") - F.col("skip"))
        columns = ["source", "start", part.alias("piece")]
        left = (
            new.select(*columns).unionByName(carried.select(*columns))
            .groupBy("source")
            .agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"))
            .select("source", joined_pieces(F.col("pieces")["piece"], bool(self.decode)).alias("tail"))
        )
        moved = ends.join(left, "source", "left").select(
            "source",
            F.coalesce("tail", F.lit(b"") if self.decode else F.array().cast("array<int>")).alias("tail"),
            (F.col("old_next") + F.expr(f"total div {self.block_size}L")).alias("next_block"),
        )
        return moved.unionByName(state.join(moved.select("source"), "source", "left_anti"))
