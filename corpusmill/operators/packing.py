"""Token streams cut into fixed windows: packing, capping, shard numbering."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import EOS_ID, byte_ids, with_eos
from corpusmill.operators.offsets import keep_heads, range_bits, running_start


def token_offsets(docs: DataFrame, n_tokens: str = "n_tokens", bits: Sequence[int] | None = None) -> DataFrame:
    """Start of each document in its source's stream, one EOS after each.

    Documents without tokens take no room and are dropped.
    """
    kept = docs.where(F.col(n_tokens) > 0).withColumn("stream_tokens", F.col(n_tokens).cast("bigint") + 1)
    return running_start(kept, ["source"], "doc_id", "stream_tokens", bits)


def joined_pieces(parts: Column, as_bytes: bool) -> Column:
    """An array of pieces as one."""
    return F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part)) if as_bytes else F.flatten(parts)


def join_pieces(pieces: DataFrame, keys: Sequence[str], as_bytes: bool) -> DataFrame:
    """Concatenate the pieces of each window in stream order.

    A window has at most one piece per token, so no group is unbounded.
    """
    in_order = F.sort_array(F.collect_list(F.struct("pos", "tokens")))
    joined = joined_pieces(F.col("pieces")["tokens"], as_bytes)
    return (
        pieces.groupBy(*keys)
        .agg(in_order.alias("pieces"))
        .select(*keys, joined.alias("tokens"))
    )


def cut_stream(
    rows: DataFrame,
    group: Sequence[str],
    tokens: Column,
    length: str,
    size: int,
    step: int | None = None,
    max_windows: Column | None = None,
    placed_by: Sequence[str] = ("rng",),
    decode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Cut streams into windows of ``size`` tokens starting every ``step``.

    ``rows`` come from :func:`running_start`; ``tokens`` is evaluated only for
    rows that the cap leaves.  Full windows come out, as (group, window_id,
    tokens).  With ``decode``, ``tokens`` is a column of bytes, one per token, and
    is cut as such; ``decode`` makes the tokens of finished windows.

    A window that lies within one row is cut out as it is.  The others are put
    together from pieces, a few per row: inside the task that already holds the
    range, or after a shuffle if they lie across two ranges.  All branches read
    the same exchange.  ``placed_by`` are the columns that name a range and by
    which, or some of which, the rows are placed already.
    """
    step = step or size
    keys = [*group, "window_id"]
    end = F.col("start") + F.col(length)
    first = F.when(F.col("start") < size, F.lit(0)).otherwise(F.expr(f"(start - {size}L) div {step}L + 1"))
    last = F.expr(f"(start + {length} - 1) div {step}L")
    if max_windows is not None:
        last = F.least(last, max_windows - 1)
    spans = (
        rows.withColumn("end", end)
        .withColumn("first", first.cast("bigint"))
        .withColumn("last", last.cast("bigint"))
        .where("last >= first")
        # windows that lie within the row; from "last" + 1 to "last" if there is none
        .withColumn("first_whole", F.expr(f"(start + {step - 1}L) div {step}L"))
        .withColumn("last_whole", F.least(F.col("last"), F.expr(f"if(end < {size}L, -1L, (end - {size}L) div {step}L)")))
        .withColumn("has_whole", F.expr("last_whole >= first_whole"))
        .withColumn("first_whole", F.expr("if(has_whole, first_whole, last + 1)"))
        .withColumn("last_whole", F.expr("if(has_whole, last_whole, last)"))
    )

    def crosses(window: Column) -> Column:
        opens = window * step
        return (opens < F.col("rng_start")) | (opens + size > F.col("rng_end"))

    def cut(part: DataFrame, windows: Column, *local: str) -> DataFrame:
        def low_of(window: Column) -> Column:
            return F.greatest(window * step, F.col("start"))

        def high_of(window: Column) -> Column:
            return F.least(window * step + size, F.col("end"))

        names = dict.fromkeys([*group, *local])
        if decode:
            # bytes are cut where the row is at hand: exploded rows never carry a whole text
            def piece(window: Column) -> Column:
                low = low_of(window)
                at, n = (low - F.col("start") + 1).cast("int"), (high_of(window) - low).cast("int")
                return F.struct(window.alias("window_id"), low.alias("pos"), F.substring(tokens, at, n).alias("tokens"))

            return part.select(*names, F.inline(F.transform(windows, piece)))
        low = low_of(F.col("window_id"))
        return (
            part.withColumn("tokens", tokens)
            .select(*names, "start", "end", "tokens", F.explode(windows).alias("window_id"))
            .select(
                *names, "window_id", low.alias("pos"),
                F.slice("tokens", (low - F.col("start") + 1).cast("int"), (high_of(F.col("window_id")) - low).cast("int")).alias("tokens"),
            )
        )

    local = [c for c in placed_by if c not in keys]
    # always true: asks for all columns of the other branches, so that Spark shares their exchange
    in_range = F.when((F.col("start") >= F.col("rng_start")) | (end <= F.col("rng_end")) | (F.hash(*placed_by) != 0), True).otherwise(False)
    whole = cut(spans.where(F.col("has_whole") & in_range), F.sequence("first_whole", "last_whole"))
    before = F.expr("if(first < first_whole, sequence(first, first_whole - 1), array())")
    after = F.expr("if(last_whole < last, sequence(last_whole + 1, last), array())")
    parted = F.concat(before, after)
    inside = join_pieces(cut(spans, F.filter(parted, lambda w: ~crosses(w)), *local), [*keys, *local], bool(decode))
    edges = spans.where(crosses(F.col("first")) | crosses(F.col("last")))
    across = join_pieces(cut(edges, F.filter(parted, crosses)), keys, bool(decode))
    across = across.where((F.octet_length("tokens") if decode else F.size("tokens")) == size)
    windows = whole.select(*keys, "tokens").unionByName(inside.select(*keys, "tokens")).unionByName(across)
    return windows.withColumn("tokens", decode(F.col("tokens"))) if decode else windows


def pack_blocks(
    docs: DataFrame,
    block_size: int,
    tokens: Column | None = None,
    eos_id: int = EOS_ID,
    max_tokens: int | None = None,
    bits: Sequence[int] | None = None,
    of_bytes: str | None = None,
    as_bytes: bool = False,
) -> DataFrame:
    """Pack documents (source, doc_id, n_tokens, ...) into full blocks.

    ``tokens`` defaults to the column of that name; ``of_bytes`` names one of
    :func:`text_stream` instead, whose ids are made once a block is cut,
    or left to the caller with ``as_bytes``.  EOS follows every
    document; the tail of a source that fills no block is dropped.  With
    ``max_tokens`` each source ends at the block that reaches the cap.
    """
    if tokens is None and not of_bytes:
        tokens = F.col("tokens")
    cap = None
    if max_tokens is not None:
        blocks = capped_blocks(max_tokens, block_size)
        bits = bits or range_bits(docs, ["source"], "doc_id")
        docs = keep_heads(docs.where("n_tokens > 0"), "source", "doc_id", F.col("n_tokens") + 1, blocks * block_size, bits)
        cap = F.lit(blocks).cast("bigint")
    return cut_stream(
        token_offsets(docs, bits=bits), ["source"], F.col(of_bytes) if of_bytes else with_eos(tokens, eos_id),
        "stream_tokens", block_size, max_windows=cap, decode=None if not of_bytes else (lambda c: c) if as_bytes else partial(byte_ids, eos_id=eos_id),
    ).withColumnRenamed("window_id", "block_id")


def capped_blocks(max_tokens: int, block_size: int) -> int:
    """Blocks a source may have: the one that reaches the cap is kept."""
    return max(1, -(-max_tokens // block_size))
