"""Words of a text: Spark columns for the native operators, numpy for the others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; everything else belongs to a word
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
#: ASCII but a-z and 0-9; everything else belongs to a word of a lower-cased text
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does just that on ASCII texts."""
    replaced = text
    for upper, lower in zip(UPPER, LOWER):  # byte searches, cheaper than translate's look-up of each character
        replaced = F.replace(replaced, F.lit(upper), F.lit(lower))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(replaced)


def split_words(text: Column, between: str) -> Column:
    """The words of a non-null text, in order."""
    return F.array_remove(F.split(text, between), "")


def space_words(text: Column) -> Column:
    """As ``split_words(text, SPACES)``; a split at one plain character needs no pattern matcher."""
    for char in SPACE_CHARS[1:]:
        text = F.replace(text, F.lit(char), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated a single time for the row."""
    return F.get(F.transform(F.array(value), body), 0)


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that tell rows with different ids or texts apart: results depend on nothing else."""
    return [F.col(doc_id), F.md5(F.encode(whole(F.col(text)), "UTF-8")).alias("text_md5")]


#: a column that holds a whole row, so that helper columns beside it clash with none of its own
ROW = "_corpusmill_row"


def whole_rows(docs: DataFrame) -> DataFrame:
    """Rows (ROW, doc_id, text_md5)."""
    return docs.select(F.struct("*").alias(ROW), *row_key())


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by (doc_id, text_md5); a null doc_id equals another one."""
    names = {"doc_id": "_corpusmill_id", "text_md5": "_corpusmill_md5"}
    right = right.withColumnsRenamed(names)
    on = left["doc_id"].eqNullSafe(F.col(names["doc_id"])) & (left["text_md5"] == F.col(names["text_md5"]))
    return left.join(right, on, how).drop(*names.values())


# --- numpy -------------------------------------------------------------------
_RANDOM = np.random.default_rng(20240607)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII white space made plain spaces
PLAIN_SPACES = bytes(32 if _IS_SPACE[b] else b for b in range(256))
#: bytes hashed in one go; one longer text still goes in one piece
HASH_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for i, base in enumerate((_BASE, _BASE_INVERSE)):
                steps = np.full(max(n, HASH_BYTES) + 1, np.uint64(base))
                steps[0] = 1
                _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one places of the words in bytes that end with white space."""
    space = _IS_SPACE[buffer]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], inside[:-1])))
    return starts, ends


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a buffer.

    They are sums of byte codes times powers of a base, so one running sum over
    the buffer gives them all.
    """
    powers, inverses = _powers(len(buffer) + 1)
    with np.errstate(over="ignore"):
        sums = np.cumsum(_BYTE_CODES[buffer] * powers[: len(buffer)], dtype=np.uint64)
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        return mix((sums[ends - 1] - before) * inverses[starts] + (ends - starts).astype(np.uint64))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (ASCII white space between them) of several texts, and the words per text."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, ends = word_spans(buffer)
    words = span_hashes(buffer, starts, ends)
    text_starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
    return words, np.diff(bounds)


def in_pieces(texts: list[bytes]):
    """(first, last + 1) of runs of texts of about HASH_BYTES together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= HASH_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def cut_pieces(raw: bytes, size: int = HASH_BYTES) -> Iterator[bytes]:
    """A text whose words stand between plain spaces, in pieces of about ``size`` bytes that cut no word."""
    at = 0
    while len(raw) - at > size:
        end = raw.rfind(b" ", at, at + size)
        if end <= at:
            end = raw.find(b" ", at + size)
        if end < 0:
            break
        yield raw[at:end]
        at = end + 1
    yield raw[at:] if at else raw
