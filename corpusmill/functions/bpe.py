"""Encoding and decoding with a piece table, inside Arrow batches."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import FIRST_BYTE_ID, FIRST_MERGE_ID, MAX_TOKEN_ID, USER_SYMBOLS, WORD_MARK

#: segments remembered per Python worker; the memo is emptied when it is full
MEMO_SEGMENTS = 500_000
#: longest segment merged without a heap; above all ids
SHORT_SEGMENT, NO_PIECE = 48, MAX_TOKEN_ID + 1

_SYMBOL = re.compile("(" + "|".join(re.escape(s) for s in USER_SYMBOLS) + ")")
_SEGMENT = re.compile(f"{WORD_MARK}*[^{WORD_MARK}]+|{WORD_MARK}+")


def _merged_short(segment: str, ids: dict[str, int]) -> list[str]:
    """:func:`_merged_parts` of a few characters, where looking at all pairs is faster than a heap."""
    parts = list(segment)
    numbers = [ids.get(a + b, NO_PIECE) for a, b in zip(segment, segment[1:])]
    while numbers and (least := min(numbers)) != NO_PIECE:
        at = numbers.index(least)
        parts[at] += parts.pop(at + 1)
        del numbers[at]
        if at < len(numbers):
            numbers[at] = ids.get(parts[at] + parts[at + 1], NO_PIECE)
        if at:
            numbers[at - 1] = ids.get(parts[at - 1] + parts[at], NO_PIECE)
    return parts


def _merged_parts(segment: str, ids: dict[str, int]) -> list[str]:
    """Join the leftmost pair of lowest id until none is known.

    Pairs wait in a heap; joining two parts adds at most two pairs, so a segment
    of any length takes a few steps per character.
    """
    parts: list[str | None] = list(segment)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap = [(ids[a + b], i) for i, (a, b) in enumerate(zip(segment, segment[1:])) if a + b in ids]
    heapify(heap)
    while heap:
        number, at = heappop(heap)
        right = after[at]
        # the entry is stale if one of its sides has been joined to something else
        if parts[at] is None or right >= len(parts) or ids.get(parts[at] + parts[right]) != number:
            continue
        parts[at] += parts[right]
        parts[right] = None
        after[at] = after[right]
        if after[at] < len(parts):
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] < len(parts):
                number = ids.get(parts[left] + parts[after[left]])
                if number is not None:
                    heappush(heap, (number, left))
    return [part for part in parts if part is not None]


def merge_segment(segment: str, ids: dict[str, int]) -> list[int]:
    """Ids of one segment; characters without a piece become byte ids."""
    out: list[int] = []
    for part in (_merged_short if len(segment) <= SHORT_SEGMENT else _merged_parts)(segment, ids):
        known = ids.get(part)
        if known is None:
            out.extend(FIRST_BYTE_ID + byte for byte in part.encode("utf-8", errors="replace"))
        else:
            out.append(known)
    return out


class _Memo(dict):
    """Segments met so far, with their ids as bytes of 32-bit numbers; others are encoded when asked for."""

    def __init__(self, ids: dict[str, int]):
        super().__init__()
        self.ids = ids

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= MEMO_SEGMENTS:
            self.clear()
        known = self[segment] = array("i", merge_segment(segment, self.ids)).tobytes()
        return known


def text_encoder(pieces: dict[str, int]) -> Callable[[str], bytes]:
    """Encoder of whole texts, to bytes of 32-bit ids, that remembers the segments it has met."""
    memo = _Memo({piece: number for piece, number in pieces.items() if number >= FIRST_MERGE_ID})
    symbols = {symbol: array("i", [pieces[symbol]]).tobytes() for symbol in USER_SYMBOLS if symbol in pieces}

    def encode(text: str) -> bytes:
        if not text:
            return b""
        out = []
        for part in _SYMBOL.split(WORD_MARK + text.replace(" ", WORD_MARK)):
            if part in symbols:
                out.append(symbols[part])
            else:
                out += map(memo.__getitem__, _SEGMENT.findall(part))
        return b"".join(out)

    return encode


def collect_pieces(vocab: DataFrame) -> dict[str, int]:
    """The piece table on the driver; ids are 16-bit, so at most 65,536 rows."""
    rows = vocab.select("piece", "id").limit(MAX_TOKEN_ID + 2).collect()
    if len(rows) > MAX_TOKEN_ID + 1:
        raise ValueError("a vocabulary has at most 65,536 pieces")
    return {row["piece"]: row["id"] for row in rows}


def bpe_encoder(vocab: DataFrame) -> Callable[[Column], Column]:
    """A column function text → token ids for the given vocabulary table."""
    shared = vocab.sparkSession.sparkContext.broadcast(collect_pieces(vocab))
    encoders: list[Callable[[str], list[int]]] = []

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(text: pa.Array) -> pa.Array:
        if not encoders:
            encoders.append(text_encoder(shared.value))
        ids = [encoders[0](t or "") for t in text.to_pylist()]
        ends = np.cumsum([0, *[len(i) // 4 for i in ids]])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))

    return lambda text: encode(text)


def bpe_decoder(vocab: DataFrame) -> Callable[[Column], Column]:
    """A column function token ids → text; byte pieces are joined before decoding."""
    table = {number: piece for piece, number in collect_pieces(vocab).items()}
    by_id = [_piece_bytes(number, table.get(number, "")) for number in range(max(table) + 1)]
    shared = vocab.sparkSession.sparkContext.broadcast(by_id)

    @F.arrow_udf(T.StringType())
    def decode(tokens: pa.Array) -> pa.Array:
        known = shared.value
        ids, ends = tokens.values.to_numpy(zero_copy_only=False), tokens.offsets.to_numpy()
        own = (ids[first:last].tolist() if valid else () for first, last, valid in zip(ends[:-1], ends[1:], tokens.is_valid().to_pylist()))
        texts = (b"".join(map(known.__getitem__, i)).decode("utf-8", errors="replace") for i in own)
        # the dummy prefix gives every text one leading space
        return pa.array([text[1:] if text.startswith(" ") else text for text in texts], pa.string())

    return lambda tokens: decode(tokens)


def _piece_bytes(number: int, piece: str) -> bytes:
    if FIRST_BYTE_ID <= number < FIRST_MERGE_ID:
        return bytes([number - FIRST_BYTE_ID])
    if number < FIRST_BYTE_ID - len(USER_SYMBOLS):
        return b""
    return piece.replace(WORD_MARK, " ").encode("utf-8")


def byte_decode(tokens: Column) -> Column:
    """Text of byte ids, on the JVM side: pairs of hex digits back to UTF-8."""
    digits = F.transform(tokens, lambda i: F.lpad(F.hex((i - FIRST_BYTE_ID).cast("bigint")), 2, "0"))
    return F.decode(F.unhex(F.array_join(digits, "")), "UTF-8")
