"""Operator 6, byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap.  Every chunk is pre-tokenised on
its own, in parallel, from its arbitrary start.  A pre-token depends only on the
text from its start on, so from the first boundary that two neighbours share in
their overlap they agree: there the text is cut, and the spans between cuts are
encoded in parallel, each match of the pattern separately.  Where an overlap
shows no common boundary (one run longer than it), the rest of that text is one
span, so ids are exact for every text.  Texts of one chunk take no shuffle.

Only boundaries between a non-space and an ASCII space or newline are compared:
these hold whatever Unicode version a pattern library has.

Defined cases: a null text counts as empty, no ids and no bytes; repeated rows
are encoded one by one; columns beside (doc_id, text) are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.text import whole
from corpusmill.session import materialize

#: characters of a chunk, and those it shares with the next one
CHUNK_CHARS, OVERLAP_CHARS = 16_384, 512
#: without nulls, so that no plan adds a null filter and all read one exchange of chunks
CHUNKS = "_row bigint not null, chunk bigint not null, last bigint not null, part string not null"
_LOADED: dict[str, tuple] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encoding(path: str):
    """The encoding, and for decoding all token bytes in one buffer with their places."""
    if path not in _LOADED:
        import tiktoken

        ranks = load_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _LOADED[path] = (
            tiktoken.Encoding("from-file", pat_str=_pattern(), mergeable_ranks=ranks, special_tokens={}), tokens,
        )
    return _LOADED[path]


def encode_spans(path: str):
    """Column function: ids of a text that starts and ends at pre-token boundaries of its document."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding, _ = _encoding(path)
        for texts in batches:
            ids = [encoding.encode_to_numpy(text.as_py(), disallowed_special=()).astype(np.int32) for text in texts]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    return encode


def decode_ids(path: str):
    """Column function: the bytes of an array of ids; tokens may end inside a character."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, tokens = _encoding(path)
        for arrays in batches:
            values, offsets = arrays.values.to_numpy(), arrays.offsets.to_numpy()
            yield pa.array(
                [b"".join(map(tokens.__getitem__, values[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()
            )

    return decode


def _cut_chunks(chunk: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, text in zip(batch["_row"], batch["text"]):
                starts = range(0, len(text), chunk)
                yield pd.DataFrame({
                    "_row": row, "chunk": np.arange(len(starts)), "last": len(starts) - 1,
                    "part": [text[at : at + chunk + overlap] for at in starts],
                })

    return cut


def boundaries(part: str, pattern) -> list[int]:
    """Places in a chunk where a pre-token ends before an ASCII space or newline; none that touches its end."""
    ends = (match.end() for match in pattern.finditer(part))
    return [e for e in ends if e < len(part) and part[e] in " \n" and not part[e - 1].isspace()]


def _pretokenise(chunk: int, overlap: int):
    """Struct (head, tail): the boundaries in the overlaps with the chunks before and after."""

    @F.pandas_udf("head array<bigint>, tail array<bigint>")
    def find(numbers: pd.Series, parts: pd.Series) -> pd.DataFrame:
        import regex

        pattern = regex.compile(_pattern())
        heads, tails = [], []
        for number, part in zip(numbers, parts):
            places = np.array(boundaries(part, pattern), np.int64)
            heads.append(number * chunk + places[places < overlap])
            tails.append(number * chunk + places[places >= chunk])
        return pd.DataFrame({"head": heads, "tail": tails})

    return find


def stitch(chunks: DataFrame, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Rows (_row, span, text) from rows (_row, chunk, last, part): spans between common boundaries."""
    spread = chunks.repartition("_row", "chunk")
    found = spread.select("_row", "chunk", "last", _pretokenise(chunk, overlap)("chunk", "part").alias("found"))
    order = Window.partitionBy("_row").orderBy("chunk")
    met = F.array_min(F.array_intersect("found.tail", F.lead("found.head").over(order)))
    met = found.withColumn("_met", F.when(F.col("chunk") < F.col("last"), met))
    # from the first gap on nothing is proven, the rest of that text is one span
    gap = F.min(F.when((F.col("chunk") < F.col("last")) & F.col("_met").isNull(), F.col("chunk"))).over(Window.partitionBy("_row"))
    met = met.withColumn("_gap", F.coalesce(gap, F.col("last"))).withColumn("_before", F.lag("_met").over(order))
    # only boundaries meet in the windows; chunks wait where they are, in the same exchange
    cut = spread.join(met.select("_row", "chunk", "_met", "_gap", "_before"), ["_row", "chunk"])
    base = F.col("chunk") * chunk
    first = F.when(F.col("chunk") <= F.col("_gap"), F.coalesce("_before", base)).otherwise(base)
    until = F.when(F.col("chunk") < F.col("_gap"), F.col("_met")).when(F.col("chunk") < F.col("last"), base + chunk)
    piece = F.substr(F.col("part"), (first - base + 1).cast("int"), (F.coalesce(until, base + chunk + overlap) - first).cast("int"))
    alone = (F.col("chunk") < F.col("_gap")) | (F.col("_gap") == F.col("last"))
    pieces = cut.select("_row", F.least("chunk", "_gap").alias("span"), "chunk", piece.alias("text"), alone.alias("alone"))
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "text")))
    rest = pieces.where(~F.col("alone")).groupBy("_row", "span").agg(F.array_join(ordered["text"], "").alias("text"))
    return pieces.where("alone").select("_row", "span", "text").unionByName(rest)


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Rows (doc_id, ids), one per document."""
    if overlap >= chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    ids_of = encode_spans(path or default_path())
    texts = docs.select("doc_id", whole(F.col("text")).alias("text"))
    short = texts.where(F.length("text") <= chunk).select("doc_id", ids_of("text").alias("ids"))
    # written once, so that row numbers hold if a task is run again
    long = materialize(texts.where(F.length("text") > chunk).withColumn("_row", F.monotonically_increasing_id()), "long-texts")
    chunks = long.select("_row", "text").mapInPandas(_cut_chunks(chunk, overlap), CHUNKS)
    spans = stitch(chunks, chunk, overlap).select("_row", "span", ids_of("text").alias("ids"))
    joined = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("span", "ids"))).alias("spans"))
    whole_ids = joined.select("_row", F.flatten(F.col("spans.ids")).alias("ids"))
    return short.unionByName(long.select("_row", "doc_id").join(whole_ids, "_row").select("doc_id", "ids"))


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, ids, decoded): the ids of each text and the bytes they stand for."""
    path = path or default_path()
    return encode(docs, path).withColumn("decoded", decode_ids(path)("ids"))


def digest(encoded: DataFrame) -> DataFrame:
    """The contract's columns of ``encode_decode``."""
    decimal: Column = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
