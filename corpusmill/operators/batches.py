"""Training rows cut from token streams: labels, epochs, batch windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import EOS_ID, with_eos
from corpusmill.operators.packing import cut_stream, join_pieces, token_offsets


def next_token_labels(docs: DataFrame, block_size: int, tokens: Column | None = None, eos_id: int = EOS_ID) -> DataFrame:
    """Blocks with the label of each token: the next token of the stream.

    Labels cross document and block edges, so a window one token longer than
    the block is cut at every block start.
    """
    tokens = F.col("tokens") if tokens is None else tokens
    windows = cut_stream(
        token_offsets(docs), ["source"], with_eos(tokens, eos_id), "stream_tokens", block_size + 1, step=block_size
    )
    return windows.select(
        "source",
        F.col("window_id").alias("block_id"),
        F.slice("tokens", 1, block_size).alias("input_ids"),
        F.slice("tokens", 2, block_size).alias("labels"),
    )


def shuffle_key(seed: int, epoch: int) -> Column:
    """A repeatable random key per shard copy and epoch."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(str(seed)), F.lit(str(epoch)), F.col("source"), F.col("shard_id").cast("string"), F.col("copy").cast("string")
        )
    )


def epoch_order(mix: DataFrame, epoch: int, seed: int, range_hex: int = 3) -> DataFrame:
    """Shard copies of one epoch in shuffled order, with their stream starts.

    The key's first digits are ranges, 16 ** ``range_hex`` at most.  Places and
    starts are running sums inside a range, on top of the range's own; only
    range totals meet in one window.
    """
    keyed = mix.withColumn("epoch", F.lit(epoch)).withColumn("shuffle_key", shuffle_key(seed, epoch))
    keyed = keyed.withColumn("rng", F.substring("shuffle_key", 1, range_hex))
    totals = keyed.groupBy("epoch", "rng").agg(F.count("*").alias("copies"), F.sum("n_tokens").alias("tokens"))
    earlier = Window.partitionBy("epoch").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    bases = totals.select(
        "epoch", "rng", F.coalesce(F.sum("copies").over(earlier), zero).alias("first_place"),
        F.coalesce(F.sum("tokens").over(earlier), zero).alias("first_token"),
    )
    order = Window.partitionBy("epoch", "rng").orderBy("shuffle_key", "source", "shard_id", "copy")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("_place", F.row_number().over(order).cast("bigint") - 1).withColumn(
        "_start", F.coalesce(F.sum("n_tokens").over(before), zero)
    )
    return inside.join(bases, ["epoch", "rng"]).select(
        "epoch", (F.col("first_place") + F.col("_place")).alias("place"), "source", "shard_id", "copy", "n_tokens",
        (F.col("first_token") + F.col("_start")).alias("shard_start"),
    )


def batch_windows(
    blocks: DataFrame, order: DataFrame, block_size: int, seq_len: int, micro_batch: int,
    decode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Training rows of one epoch: windows of L·m+1 tokens, one shared token.

    Leftover tokens of a shard run on into the next.  A shard copy is a range
    of the stream, so a window inside it is cut from the block in which it opens
    and those that follow: tokens are moved and sorted once, by shard, however
    many copies the mix has, and move again only at the edges of shards.  With
    ``decode`` the blocks' ``tokens`` are bytes, and ids are made of finished rows.
    """
    step = seq_len * micro_batch
    size = step + 1
    own = blocks.select("source", "shard_id", "block_in_shard", "tokens")
    copies = order.select("epoch", "source", "shard_id", "shard_start", (F.col("shard_start") + F.col("n_tokens")).alias("shard_end"))

    def placed(rows: DataFrame) -> DataFrame:
        start = F.col("shard_start") + F.col("block_in_shard") * block_size
        return rows.join(copies, ["source", "shard_id"]).withColumn("start", start).withColumn("end", start + block_size)

    def cut(rows: DataFrame, windows: Column, tokens: str) -> DataFrame:
        def piece(window: Column) -> Column:
            low = F.greatest(window * step, F.col("start"))
            at, n = (low - F.col("start") + 1).cast("int"), (F.least(window * step + size, F.col("until")) - low).cast("int")
            part = F.substring(tokens, at, n) if decode else F.slice(tokens, at, n)
            return F.struct(window.alias("window_id"), low.alias("pos"), part.alias("tokens"))

        return rows.select("epoch", F.inline(F.transform(windows, piece)))

    in_order = Window.partitionBy("source", "shard_id").orderBy("block_in_shard")
    none = F.lit(b"") if decode else F.slice("tokens", 1, 0)
    following = [F.coalesce(F.lead("tokens", n).over(in_order), none) for n in range(1, -(-step // block_size) + 1)]
    runs = placed(own.withColumn("run", F.concat("tokens", *following)).drop("tokens")).withColumn("until", F.col("shard_end"))
    runs = runs.withColumn("first", F.expr(f"(start + {step - 1}L) div {step}L")).withColumn(
        "last", F.expr(f"least((end - 1) div {step}L, if(shard_end < {size}L, -1L, (shard_end - {size}L) div {step}L))")
    )
    inside = cut(runs.where("last >= first"), F.sequence("first", "last"), "run")

    edges = placed(own).withColumn("until", F.col("end"))
    edges = edges.where((F.col("start") < F.col("shard_start") + size) | (F.col("end") > F.col("shard_end") - size))
    met = F.sequence(F.expr(f"if(start < {size}L, 0L, (start - {size}L) div {step}L + 1)"), F.expr(f"(end - 1) div {step}L"))
    crossing = F.filter(met, lambda window: (window * step < F.col("shard_start")) | (window * step + size > F.col("shard_end")))
    across = join_pieces(cut(edges, crossing, "tokens"), ["epoch", "window_id"], bool(decode))
    across = across.where((F.octet_length("tokens") if decode else F.size("tokens")) == size)
    windows = inside.select("epoch", "window_id", "tokens").unionByName(across)
    offset = F.col("row") * seq_len

    def part(at: Column) -> Column:
        return decode(F.substring("tokens", at, F.lit(seq_len))) if decode else F.slice("tokens", at, F.lit(seq_len))

    return windows.select(
        "epoch", F.col("window_id").alias("batch_id"), "tokens", F.explode(F.sequence(F.lit(0), F.lit(micro_batch - 1))).alias("row")
    ).select("epoch", "batch_id", "row", part(offset + 1).alias("input_ids"), part(offset + 2).alias("labels"))
