"""The state of byte-pair training: chunks of words, changed where a pair is merged.

A chunk is a row that holds some words as one run of symbol numbers, each word
ended by 0, and the words' counts.  A round looks up where the pairs to merge
stand, joins them, and compares the pairs of the words so touched before and
after; all other words stay as they are.  What changed in the pair counts comes
out beside the new chunks, so pairs are counted in full only when the driver's
table of the most frequent ones has run out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words of a chunk, and symbols after which it ends earlier
CHUNK_WORDS, CHUNK_SYMBOLS = 1 << 16, 1 << 20
STATE = "symbols binary, counts binary, pair bigint, n bigint"
#: a pair of symbol numbers as one number
SHIFT = 16
MASK = (1 << SHIFT) - 1


def pair_code(left, right):
    return (left << SHIFT) | right


def _batch(symbols: list[bytes], counts: list[bytes], pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    words, changes = len(symbols), len(pairs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(symbols + [None] * changes, pa.binary()), pa.array(counts + [None] * changes, pa.binary()),
            pa.concat_arrays([pa.nulls(words, pa.int64()), pa.array(pairs, pa.int64())]),
            pa.concat_arrays([pa.nulls(words, pa.int64()), pa.array(n, pa.int64())]),
        ],
        ["symbols", "counts", "pair", "n"],
    )


def make_chunks(runs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """Chunks of rows (run, n); every character of a run has a number from 1 on."""
    shared = runs.sparkSession.sparkContext.broadcast(numbers)

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, symbols, counts = shared.value, [], []
        for batch in batches:
            for run, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                symbols += map(known.__getitem__, run)
                symbols.append(0)
                counts.append(n)
                if len(counts) >= CHUNK_WORDS or len(symbols) >= CHUNK_SYMBOLS:
                    yield _batch([np.array(symbols, "<u2").tobytes()], [np.array(counts, "<i8").tobytes()], np.zeros(0, int), np.zeros(0, int))
                    symbols, counts = [], []
        if counts:
            yield _batch([np.array(symbols, "<u2").tobytes()], [np.array(counts, "<i8").tobytes()], np.zeros(0, int), np.zeros(0, int))

    return runs.select("run", "n").mapInArrow(chunk, STATE)


def count_pairs(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours inside words and the counts of their words."""
    word = np.cumsum(symbols == 0)[:-1]
    inside = (symbols[:-1] != 0) & (symbols[1:] != 0)
    codes = pair_code(symbols[:-1][inside], symbols[1:][inside])
    found, where = np.unique(codes, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, counts[word[inside]])
    return found, total


def merge_places(symbols: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where one of the pairs (sorted ``codes``) is merged, and which; no two places overlap."""
    lefts, rights = np.zeros(MASK + 1, bool), np.zeros(MASK + 1, bool)
    lefts[codes >> SHIFT] = True
    rights[codes & MASK] = True
    maybe = np.flatnonzero(lefts[symbols[:-1]] & rights[symbols[1:]])
    here = pair_code(symbols[maybe], symbols[maybe + 1])
    which = np.minimum(np.searchsorted(codes, here), len(codes) - 1)
    hit = codes[which] == here
    maybe, which = maybe[hit], which[hit]
    # places side by side occur for a pair of equal symbols: every second one, from the left
    run = np.flatnonzero(np.diff(maybe, prepend=-2) != 1)
    offset = np.arange(len(maybe)) - np.repeat(run, np.diff(np.append(run, len(maybe))))
    return maybe[offset % 2 == 0], which[offset % 2 == 0]


def merge_chunk(
    symbols: np.ndarray, counts: np.ndarray, codes: np.ndarray, merged: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunk after merging, and the pairs whose counts changed, with the change."""
    none = np.zeros(0, np.int64)
    at, which = merge_places(symbols, codes)
    if not len(at):
        return symbols, none, none
    ends = np.flatnonzero(symbols == 0)
    touched = np.zeros(len(ends), bool)
    touched[np.searchsorted(ends, at)] = True
    lengths = np.diff(ends, prepend=-1)
    before = symbols[np.repeat(touched, lengths)]
    joined = symbols.copy()
    joined[at] = merged[which]
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    after = joined[keep & np.repeat(touched, lengths)]
    (old, less), (new, more) = (count_pairs(x, counts[touched]) for x in (before, after))
    pairs, where = np.unique(np.concatenate((old, new)), return_inverse=True)
    change = np.zeros(len(pairs), np.int64)
    np.add.at(change, where, np.concatenate((-less, more)))
    return joined[keep], pairs[change != 0], change[change != 0]


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    for symbols, counts in zip(batch.column(0), batch.column(1)):
        raw = counts.as_py()
        yield np.frombuffer(symbols.as_py(), "<u2").astype(np.int64), np.frombuffer(raw, "<i8"), raw


def chunks_of(state: DataFrame) -> DataFrame:
    return state.where(F.col("symbols").isNotNull())


def merge_round(state: DataFrame, pairs: list[tuple[int, int, int]], watched: np.ndarray) -> DataFrame:
    """The state after merging pairs (left, right, merged), with changes of pairs that matter.

    Those are the watched pairs (sorted codes), and pairs with a merged symbol.
    """
    order = sorted((pair_code(left, right), to) for left, right, to in pairs)
    codes = np.array([code for code, _ in order], np.int64)
    merged = np.array([to for _, to in order], np.int64)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_new = np.zeros(MASK + 1, bool)
        is_new[merged] = True
        for batch in batches:
            for symbols, counts, raw in _arrays(batch):
                after, changed, change = merge_chunk(symbols, counts, codes, merged)
                matters = is_new[changed >> SHIFT] | is_new[changed & MASK]
                if len(watched):
                    matters |= watched[np.minimum(np.searchsorted(watched, changed), len(watched) - 1)] == changed
                yield _batch([after.astype("<u2").tobytes()], [raw], changed[matters], change[matters])

    return chunks_of(state).mapInArrow(step, STATE)


def all_pairs(state: DataFrame) -> DataFrame:
    """Rows (pair, n) of all pairs with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for symbols, counts, _ in _arrays(batch):
                found, total = count_pairs(symbols, counts)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["pair", "n"])

    return chunks_of(state).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def changes(state: DataFrame) -> DataFrame:
    return state.where(F.col("symbols").isNull()).groupBy("pair").agg(F.sum("n").alias("n"))
