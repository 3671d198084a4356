"""Byte-pair vocabulary training as Spark jobs over the distinct-word table."""

from __future__ import annotations

import time
from collections.abc import Callable, Container
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.segments import chunk_segments, line_chunks, training_lines
from corpusmill.functions.text import (
    CONTROL_PIECES,
    FIRST_BYTE_ID,
    FIRST_MERGE_ID,
    MAX_TOKEN_ID,
    USER_SYMBOLS,
)
from corpusmill.operators.bpe_rounds import MASK, SHIFT, all_pairs, changes, chunks_of, make_chunks, merge_round
from corpusmill.session import cut_lineage, materialize, spread

OPEN, CLOSE = "\x01", "\x02"  # around every symbol of a word in `covered_words`
#: most frequent pairs fetched at a time
TOP_PAIRS = 1 << 16
#: pairs looked at for one round
BATCH_PAIRS = 1024
#: rounds between checkpoints of the word table
CHECKPOINT_ROUNDS = 16


def chunk_counts(docs: DataFrame) -> DataFrame:
    """Chunks of all training lines with their counts.

    The only step over the whole corpus; counts are combined before the shuffle.
    The patterns of scripts run on distinct chunks alone.
    """
    return (
        docs.select(F.explode(training_lines(F.col("text"))).alias("line"))
        .select(F.explode(line_chunks(F.col("line"))).alias("chunk"))
        .groupBy("chunk")
        .agg(F.count("*").alias("n"))
    )


def chunk_words(chunks: DataFrame) -> DataFrame:
    """Segments (word, n) of counted chunks."""
    return chunks.select(F.explode(chunk_segments(F.col("chunk"))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """Segments of all training lines with their counts."""
    return chunk_words(chunk_counts(docs))


def chunk_chars(chunks: DataFrame) -> DataFrame:
    """Characters (ch, n) of counted chunks."""
    return chunks.select(F.explode(F.split("chunk", "")).alias("ch"), "n").groupBy("ch").agg(F.sum("n").alias("n"))


def char_counts(docs: DataFrame) -> DataFrame:
    """Characters of all marked training lines with their counts."""
    return chunk_chars(chunk_counts(docs))


def char_coverage(counts: DataFrame, coverage: float) -> DataFrame:
    """The most frequent characters until their share reaches ``coverage``.

    The window sees one row per distinct character, at most the size of Unicode.
    """
    order = Window.orderBy(F.desc("n"), "ch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    return (
        counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("all", F.sum("n").over(everything))
        .withColumn("rank", F.row_number().over(order).cast("bigint") - 1)
        .where(F.col("before") / F.col("all") < coverage)
        .select("ch", "n", "rank")
    )


def covered_of(counts: DataFrame, coverage: float, limit: int) -> list[str]:
    """The characters (ch, n) to cover by rank; more than ``limit`` of them are an error, never cut."""
    rows = char_coverage(counts, coverage).orderBy("rank").select("ch").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} characters to cover")
    return [row["ch"] for row in rows]


def covered_chars(docs: DataFrame, coverage: float, limit: int) -> list[str]:
    """The characters of documents to cover."""
    return covered_of(char_counts(docs), coverage, limit)


def covered_runs(words: DataFrame, chars: list[str]) -> DataFrame:
    """Words cut at uncovered characters, as rows (run, n)."""
    members = "".join(rf"\x{{{ord(ch):x}}}" for ch in chars if ch not in (OPEN, CLOSE))
    runs = F.regexp_extract_all("word", F.lit(f"[{members}]+"), F.lit(0))
    return words.select(F.explode(runs).alias("run"), "n").groupBy("run").agg(F.sum("n").alias("n"))


def covered_words(words: DataFrame, chars: list[str]) -> DataFrame:
    """Words cut at uncovered characters, as wrapped symbols with counts.

    The two characters used for wrapping always fall back to bytes.
    """
    return covered_runs(words, chars).select(F.regexp_replace("run", "(?s).", f"{OPEN}$0{CLOSE}").alias("symbols"), "n")


def _inner_pairs(words: DataFrame) -> DataFrame:
    """One row (left, right, n) per pair of neighbours in a word."""
    inner = F.substring(F.col("symbols"), 2, 2**31 - 1)
    symbols = F.split(F.rtrim(inner, F.lit(CLOSE)), CLOSE + OPEN)
    size = F.size("s")
    pairs = F.arrays_zip(F.slice("s", F.lit(1), size - 1).alias("left"), F.slice("s", F.lit(2), size - 1).alias("right"))
    return words.select(symbols.alias("s"), "n").where(size > 1).select(F.inline(pairs), "n")


def pair_counts(words: DataFrame, max_piece_chars: int | None = None) -> DataFrame:
    """Adjacent symbols (left, right) with the count of their words.

    Pairs longer than ``max_piece_chars`` are left out, if that is given.
    """
    pairs = _inner_pairs(words).groupBy("left", "right").agg(F.sum("n").alias("n"))
    if max_piece_chars is None:
        return pairs
    return pairs.where(F.length("left") + F.length("right") <= max_piece_chars)


def best_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    """Highest counts first; ties by the joined piece, then by its left part."""
    return pairs.orderBy(F.desc("n"), F.concat("left", "right"), "left").limit(limit)


@dataclass(frozen=True)
class Pair:
    left: str
    right: str
    n: int

    @property
    def piece(self) -> str:
        return self.left + self.right


def safe_batch(top: list[Pair], known: Container[str], truncated: bool) -> list[Pair]:
    """The leading pairs that can be merged at once with the one-by-one result.

    Merging (A, B) changes the counts of pairs that end in A or start with B
    and no others, and each new pair comes from one of those: it is at most as
    frequent, and its piece extends theirs.  So up to the first pair of that
    kind the order is settled, but for equal counts, where a new piece A+B+x
    takes its place by spelling.  A pair of equal symbols, or one whose piece
    exists already, is merged alone.
    """
    lefts: set[str] = set()
    rights: set[str] = set()
    made: set[str] = set()
    batch: list[Pair] = []
    bound = top[-1].n if truncated else 0
    for pair in top:
        alone = pair.left == pair.right or pair.piece in known or pair.piece in made
        if alone and not batch:
            return [pair]
        if alone or pair.left in rights or pair.right in lefts:
            bound = pair.n
            break
        batch.append(pair)
        lefts.add(pair.left)
        rights.add(pair.right)
        made.add(pair.piece)
    ties_known = not truncated or bound > top[-1].n
    followers: dict[str, list[str]] = {}
    for pair in top:
        if pair.n == bound:
            followers.setdefault(pair.left, []).append(pair.right)
    accepted: list[Pair] = []
    first_new: str | None = None
    for pair in batch:
        if accepted and pair.n == bound and (not ties_known or (first_new is not None and pair.piece > first_new)):
            break
        accepted.append(pair)
        new = [pair.piece + follower for follower in followers.get(pair.right, ())]
        first_new = min([*new, first_new] if first_new is not None else new, default=None)
    return accepted


class PairTable:
    """The most frequent pairs on the driver, exact: at most ``limit`` are fetched, new ones are added.

    A pair that is not here occurs at most ``bound`` times, so the order of all
    pairs above the bound is known.  Counts of pairs of old symbols only fall;
    where a merge makes a symbol that exists already, the bound rises instead.
    If more pairs than the limit lead with equal counts, the first of them by
    spelling are fetched, and the order is known up to the last of these.
    """

    def __init__(self, pieces: list[str], limit: int = TOP_PAIRS):
        self.pieces, self.limit, self.bound = pieces, limit, 0
        self.counts: dict[int, int] = {}
        self.last: tuple[str, str] | None = None

    def fetch(self, pairs: DataFrame) -> None:
        rows = pairs.orderBy(F.desc("n")).limit(self.limit + 1).toArrow()
        found = dict(zip(rows["pair"].to_pylist(), rows["n"].to_pylist()))
        self.bound, self.last = min(found.values()) if len(found) > self.limit else 0, None
        self.counts = {code: n for code, n in found.items() if n > self.bound}
        if found and not self.counts:
            self._fetch_ties(pairs.where(F.col("n") == self.bound))

    def _fetch_ties(self, ties: DataFrame) -> None:
        names = F.broadcast(ties.sparkSession.createDataFrame(list(enumerate(self.pieces)), "number long, piece string"))
        left, right = (names.select(F.col("number").alias(f"_{c}"), F.col("piece").alias(c)) for c in ("left", "right"))
        spelled = ties.join(left, F.shiftright("pair", SHIFT) == F.col("_left")).join(right, F.col("pair").bitwiseAND(MASK) == F.col("_right"))
        first = spelled.orderBy(F.concat("left", "right"), "left").limit(self.limit).select("pair").toArrow()["pair"].to_pylist()
        self.counts = dict.fromkeys(first, self.bound)
        last = self.pair(first[-1])
        self.last = (last.piece, last.left)

    def pair(self, code: int) -> Pair:
        return Pair(self.pieces[code >> SHIFT], self.pieces[code & MASK], self.counts[code])

    def _is_settled(self, pair: Pair) -> bool:
        return pair.n > self.bound or (pair.n == self.bound and self.last is not None and (pair.piece, pair.left) <= self.last)

    def top(self, least: int) -> list[Pair]:
        """At least so many of the most frequent pairs, if there are, with all pairs of equal count, in order."""
        codes = np.fromiter(self.counts, np.int64, len(self.counts))
        n = np.fromiter(self.counts.values(), np.int64, len(self.counts))
        lowest = max(self.bound, 1, int(np.partition(n, -least)[-least]) if len(n) > least else 1)
        chosen = [p for p in (self.pair(int(code)) for code in codes[n >= lowest]) if self._is_settled(p)]
        return sorted(chosen, key=lambda p: (-p.n, p.piece, p.left))

    def watched(self, batch: list[tuple[int, int, int]]) -> np.ndarray:
        """Pairs here whose counts a merge may change, sorted."""
        codes = np.sort(np.fromiter(self.counts, np.int64, len(self.counts)))
        lefts, rights = {left for left, _, _ in batch}, {right for _, right, _ in batch}
        near = np.isin(codes & MASK, list(lefts | rights)) | np.isin(codes >> SHIFT, list(lefts | rights))
        return codes[near]

    def update(self, rows, fresh: set[int]) -> None:
        """Enter changes; ``fresh`` are the symbols that did not exist before."""
        rise = 0
        for code, n in zip(rows["pair"].to_pylist(), rows["n"].to_pylist()):
            if code in self.counts:
                self.counts[code] += n
                if self.counts[code] <= 0:
                    del self.counts[code]
            elif not self.bound or code >> SHIFT in fresh or code & MASK in fresh:
                if n >= max(self.bound, 1):
                    self.counts[code] = n
            else:
                rise = max(rise, n)
        if rise:
            self.bound, self.last = self.bound + rise, None


def train_bpe(
    words: DataFrame, chars: list[str], n_merges: int, one_by_one: bool = False, on_round: Callable[[float], None] | None = None
) -> list[str]:
    """The first ``n_merges`` merged pieces, in merge order.

    ``words`` are counted segments (word, n).  The words stay distributed as
    chunks; a round changes the words that hold a merged pair and sums up what
    this changes in the pair counts.  The driver holds the pieces and a table of
    the most frequent pairs, at most ``TOP_PAIRS`` and the pairs of pieces made since.
    A round reads the chunks of the round before from the cache, and what is
    lost of them is rebuilt from the last checkpoint.  ``on_round`` gets the
    seconds of each round.
    """
    chars = [ch for ch in dict.fromkeys(chars) if ch not in (OPEN, CLOSE)]
    pieces = ["", *chars]
    numbers = {piece: i for i, piece in enumerate(pieces)}
    runs = spread(cut_lineage(covered_runs(words, chars)), "run") if chars else None
    if runs is None:
        return []
    state = cut_lineage(make_chunks(runs, numbers))
    table = PairTable(pieces)
    table.fetch(all_pairs(state))
    merged: list[str] = []
    older: DataFrame | None = None
    rounds = 0
    while len(merged) < n_merges:
        began = time.perf_counter()
        top = table.top(1 if one_by_one else BATCH_PAIRS)
        if not top and table.bound:
            table.fetch(all_pairs(state))
            top = table.top(1 if one_by_one else BATCH_PAIRS)
        if not top:
            break
        # pairs that are not known may be as frequent as the last ones here
        batch = top[:1] if one_by_one else safe_batch(top, numbers, top[-1].n == table.bound)
        todo, fresh = [], set()
        for pair in batch:
            if pair.piece not in numbers:
                if len(pieces) > MASK:
                    raise ValueError(f"at most {MASK} different symbols")
                fresh.add(len(pieces))
                numbers[pair.piece] = len(pieces)
                pieces.append(pair.piece)
                merged.append(pair.piece)
            todo.append((numbers[pair.left], numbers[pair.right], numbers[pair.piece]))
        after = merge_round(state, todo, table.watched(todo)).persist()
        table.update(changes(after).where((F.col("n") < 0) | (F.col("n") >= table.bound) | F.lit(not fresh)).toArrow(), fresh)
        if older is not None:
            older.unpersist()
        older, state = after, after
        rounds += 1
        if rounds % CHECKPOINT_ROUNDS == 0:
            state = cut_lineage(chunks_of(after))
            after.unpersist()
            older = None
        if on_round:
            on_round(time.perf_counter() - began)
    if older is not None:
        older.unpersist()
    return merged[:n_merges]


def assemble_vocab(spark: SparkSession, merged: list[str], chars: list[str]) -> DataFrame:
    """Vocabulary (id, piece, score, kind): control, user, bytes, merges, characters."""
    head = [(i, piece, 0, "control") for i, piece in enumerate(CONTROL_PIECES)]
    head += [(i, piece, 0, "user") for i, piece in enumerate(USER_SYMBOLS, start=len(CONTROL_PIECES))]
    head += [(FIRST_BYTE_ID + b, f"<0x{b:02X}>", 0, "byte") for b in range(256)]
    tail = [(FIRST_MERGE_ID + i, p, -i, "merge") for i, p in enumerate(merged)]
    tail += [(FIRST_MERGE_ID + i, p, -i, "char") for i, p in enumerate(chars, start=len(merged))]
    if len(head) + len(tail) > MAX_TOKEN_ID + 1:
        raise ValueError("a vocabulary has at most 65,536 pieces")
    return spark.createDataFrame(head + tail, "id int, piece string, score int, kind string")


def train_vocab(docs: DataFrame, vocab_size: int, coverage: float = 0.9999) -> DataFrame:
    """Train a vocabulary of ``vocab_size`` pieces on sampled documents."""
    limit = vocab_size - FIRST_MERGE_ID
    chunks = materialize(chunk_counts(docs), "chunk-counts")
    chars = [ch for ch in covered_of(chunk_chars(chunks), coverage, limit) if ch not in (OPEN, CLOSE)]
    merged = train_bpe(chunk_words(chunks), chars, limit - len(chars))
    return assemble_vocab(docs.sparkSession, merged, chars)
