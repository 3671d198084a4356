"""Operator 12, near duplicates by SetSketch registers.

A document's set of shingles has ``REGISTERS`` registers.  Register i comes from
the least of the set's exponentially distributed hashes h_i, on an exponential
scale and truncated: floor(1 - log_b(min h_i)) between 0 and q + 1.  Registers
of a union are the larger ones of its parts (``merge``), and two sets agree in a
register with about their similarity, so bands of registers find candidates: at
the threshold two sets share fewer than ``SHARED_BANDS`` of the 32 bands once in
two million pairs.  A pair's similarity is then estimated jointly from the
numbers of larger, smaller and equal registers and both set sizes, as the most
likely one; a pair far below the threshold (``DEVIATIONS`` standard deviations)
goes.  What is left is confirmed on the full sets.

Copies are one class and never meet; how large groups meet is in ``meet``.

Defined cases: a text that is null or has no words has no shingles, links with
nothing and is kept; a null doc_id takes part but names a component only if all
ids of it are null, and is kept only then; repeated rows are in one component
and have one id, so all of them are kept or none; an empty table gives no rows;
long texts are hashed in pieces of a megabyte; ties cannot occur, ids order
components; columns beside (doc_id, text) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.meet import link_holders, members
from corpusmill.llm.ngram_jaccard import set_node, sets_of, shingle_sets
from corpusmill.llm.text import row_key
from corpusmill.session import materialize

SHINGLE_WORDS, PERCENT = 5, 85
REGISTERS, BAND_REGISTERS, SHARED_BANDS = 128, 4, 4
#: base of the scale, rate of the hashes, and largest register less one
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
DEVIATIONS = 4.5
#: shingles hashed at a time, so that the values stay near the core
HASH_ROWS = 1 << 15

_RANDOM = np.random.default_rng(20250311)
_MASKS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + _RANDOM.integers(0, 2, REGISTERS, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def least_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """For each set and register the least of its hashes, as fractions of 2 ** 64; all ones for an empty set."""
    out = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= HASH_ROWS):
            size += len(sets[last])
            last += 1
        full = [i for i in range(first, last) if len(sets[i])]
        if full:
            values = np.concatenate([sets[i] for i in full])
            starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
            with np.errstate(over="ignore"):
                for register in range(REGISTERS):
                    hashed = (values ^ _MASKS[register]) * _FACTORS[register]
                    out[full, register] = np.minimum.reduceat(hashed, starts)
        first = last
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (set, register) of sets of 64-bit hashes."""
    fractions = (least_hashes(sets) + 0.5) / 2.0**64
    with np.errstate(divide="ignore"):
        least = -np.log1p(-np.minimum(fractions, 1 - 2**-53)) / RATE
    found = np.floor(1 - np.log(least) / np.log(BASE))
    found[[not len(s) for s in sets]] = 0
    return np.clip(found, 0, LIMIT + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def bands(found: np.ndarray) -> np.ndarray:
    """A key per band of registers, apart between bands."""
    wide = found.astype("<u2").reshape(len(found), -1, BAND_REGISTERS).view("<u8")[:, :, 0]
    number = np.arange(wide.shape[1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = (wide ^ (number * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return (mixed * np.uint64(0xD6E8FEB86659FD93) + number).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 200) -> np.ndarray:
    """Most likely similarity of pairs, from their registers (rows of a and b) and set sizes.

    With relative sizes u and v, a register of the one set is larger with
    probability p(u - v J), of the other with p(v - u J), p(x) = -log_b(1 - x (b - 1) / b).
    """
    above, below = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - above - below
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    tried = np.linspace(0, 1, steps + 1)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    larger, smaller = p(u - v * tried), p(v - u * tried)
    likelihood = above * log(larger) + below * log(smaller) + equal * log(1 - larger - smaller)
    return tried[np.arange(len(a)), likelihood.argmax(1)]


def _describe(width: int):
    """Rows (doc_id, n, node, registers)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                sets = list(shingle_sets(part.column(1).to_pylist(), width))
                rows = registers(sets).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_node(s) for s in sets], pa.binary()),
                     pa.array([r.tobytes() if len(s) else None for r, s in zip(rows, sets)], pa.binary())],
                    ["doc_id", "n", "node", "registers"],
                )

    return describe


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = bands(_matrix(batch.column(2)))
            times = np.full(batch.num_rows, keys.shape[1])
            at = pa.array(np.repeat(np.arange(batch.num_rows), times))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column(0).take(at), batch.column(1).take(at)], ["key", "node", "n"]
            )


def _estimated(percent: int):
    share = percent / 100
    least = share - DEVIATIONS * (share * (1 - share) / REGISTERS) ** 0.5

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                found = similarity(
                    _matrix(part.column(2)), _matrix(part.column(3)),
                    part.column(4).to_numpy().astype(float), part.column(5).to_numpy().astype(float),
                )
                yield part.select([0, 1]).filter(pa.array(found >= least))

    return estimated


def sketch_documents(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, n, node, registers), written once: 300 bytes per document whatever its length."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return materialize(texts.mapInArrow(_describe(width), "doc_id bigint, n bigint, node binary, registers binary"), "sketches")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per document."""
    documents = sketch_documents(docs, width)
    classes = materialize(
        documents.where("n > 0").select("node", "n", "registers").dropDuplicates(["node"]), "sketch-classes"
    )
    holders = classes.mapInArrow(_band_keys, "key bigint, node binary, n bigint")
    holders = holders.withColumns({"k": F.lit(SHARED_BANDS), "rest": F.col("n")})

    def likely(pairs: DataFrame) -> DataFrame:
        side = lambda c: classes.select(F.col("node").alias(c), F.col("registers").alias(f"r{c}"), F.col("n").alias(f"n{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb")
        return both.mapInArrow(_estimated(percent), "a binary, b binary")

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_key()[1])
    links = link_holders(holders, lambda nodes: sets_of(nodes, texts, documents, width), percent, likely)
    return members(documents.drop("registers"), links).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
