"""Operator 8, benchmark decontamination: exact containment of item windows in documents.

A window is some consecutive words of an item.  It is a set of shingles with
places, and a document holds it only if it holds all of them, so the necessary
prefix is one shingle: the window's rarest over all documents.  Documents send
only places whose shingle is such a prefix; a place gives the one start where
the window can lie (positional bound), the window must end inside the document
(length bound), and the words there are compared exactly.

Defined cases: a null text has no words; an item without words has no window; a
null item_id marks words as hit but is no entry of the list of items; repeated
items and repeated documents are each reported; columns beside (doc_id, text)
and (item_id, text) are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.text import NON_WORD, ROW, ascii_lower, join_rows, row_key, split_words, whole, whole_rows
from corpusmill.session import cut_lineage

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: windows are broadcast up to this size, measured before; beyond it the join shuffles
BROADCAST_BYTES = 16 << 20


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(whole(text)), NON_WORD)


def shingle_at(words: Column, at: Column, n: int) -> Column:
    """Hash of ``n`` words from place ``at`` (from 0)."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(n)])


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Rows (window_words, item_ids): each distinct window and the items that have it."""
    words = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("window_words"))
        .groupBy("window_words")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )


class Windows:
    """The windows with their prefix shingles, and whether they may be broadcast."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS):
        windows = item_windows(items, window).withColumn("window_id", F.xxhash64("window_words"))
        windows = cut_lineage(windows)
        size = windows.agg(
            F.count("*").alias("n"),
            F.sort_array(F.collect_set(F.least(F.size("window_words"), F.lit(shingle)))).alias("shingles"),
            F.sum(F.octet_length(F.to_json(F.struct("window_words", "item_ids"))) + 64).alias("bytes"),
        ).first()
        self.none = not size["n"]
        self.window = window
        # windows shorter than a shingle have one of their own length
        self.sizes = size["shingles"] or [shingle]
        self.small = (size["bytes"] or 0) * shingle <= BROADCAST_BYTES
        own = F.least(F.size("window_words"), F.lit(shingle))
        each = windows.select("*", F.explode(F.sequence(F.lit(0), F.size("window_words") - own)).alias("offset"))
        h = F.coalesce(*[F.when(own == n, shingle_at(F.col("window_words"), F.col("offset"), n)) for n in self.sizes])
        each = each.withColumn("h", h)
        known = self.hint(each.select("h").distinct())
        counts = self.shingles(docs).join(known, "h", "left_semi").groupBy("h").agg(F.count("*").alias("n_corpus"))
        rarest = F.min(F.struct(F.coalesce("n_corpus", F.lit(0)).alias("n_corpus"), "h", "offset")).alias("rarest")
        prefix = (
            each.join(counts, "h", "left")
            .groupBy("window_words", "window_id", "item_ids")
            .agg(rarest)
            # absent from the corpus: the window is nowhere
            .where("rarest.n_corpus > 0")
        )
        self.table = cut_lineage(prefix.select("window_words", "window_id", "item_ids", "rarest.h", "rarest.offset"))

    def hint(self, table: DataFrame) -> DataFrame:
        return F.broadcast(table) if self.small else table

    def shingles(self, docs: DataFrame, *keep: Column) -> DataFrame:
        """A row (h, at) for each place of each document where a shingle stands."""
        words = docs.select(*keep, words_of(F.col("text")).alias("w"))
        placed = words.select(*[c for c in words.columns if c != "w"], "w", F.posexplode("w").alias("at", "_w"))
        placed = placed.where(F.col("at") <= F.size("w") - self.sizes[0])
        hashes = [shingle_at(F.col("w"), F.col("at"), n) for n in self.sizes]
        if len(hashes) == 1:
            return placed.withColumn("h", hashes[0]).drop("_w")
        fits = [F.when(F.col("at") <= F.size("w") - n, h) for n, h in zip(self.sizes, hashes)]
        return placed.withColumn("h", F.explode(F.array(*fits))).where("h is not null").drop("_w")


def find_windows(docs: DataFrame, windows: Windows) -> DataFrame:
    """Rows (doc_id, text_md5, start, n, item_ids) of windows found in documents."""
    keep = row_key()
    at = windows.shingles(docs, *keep)
    start = F.col("at") - F.col("offset")
    n = F.size("window_words")
    if windows.small:
        # candidate and check meet in one stage, so no document word is shuffled
        near, first = at, start
    else:
        # only the words that a window around this place can cover go along
        reach = windows.window
        near = at.withColumn("from", F.greatest(F.col("at") - reach, F.lit(0))).withColumn(
            "w", F.slice("w", F.col("from") + 1, 2 * reach + 1)
        )
        first = start - F.col("from")
    found = near.join(windows.hint(windows.table), "h").where(
        (start >= 0) & (first >= 0) & (first + n <= F.size("w")) & (F.slice("w", F.greatest(first, F.lit(0)) + 1, n) == F.col("window_words"))
    )
    return found.select("doc_id", "text_md5", start.alias("start"), n.alias("n"), "item_ids")


def hits_by_document(found: DataFrame) -> DataFrame:
    """Rows (doc_id, text_md5, n_hit, item_ids): words covered, and distinct items, per document.

    A group is one document's distinct window places, at most its words.
    """
    union = F.aggregate(
        F.sort_array("places"),
        F.struct(F.lit(0).alias("until"), F.lit(0).alias("n")),
        lambda have, p: F.struct(
            F.greatest(have["until"], p["start"] + p["n"]).alias("until"),
            (have["n"] + F.greatest(F.lit(0), p["start"] + p["n"] - F.greatest(have["until"], p["start"]))).alias("n"),
        ),
    )["n"]
    # one pass: the search above it runs once
    hits = found.groupBy("doc_id", "text_md5").agg(
        F.collect_set(F.struct("start", "n")).alias("places"), F.collect_set("item_ids").alias("lists")
    )
    return hits.select(
        "doc_id", "text_md5", union.cast("bigint").alias("n_hit"), F.array_distinct(F.flatten("lists")).alias("item_ids")
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: (doc_id, text_md5, n_words, n_hit, item_ids)."""
    windows = Windows(docs, items, window)
    found = cut_lineage(hits_by_document(find_windows(docs, windows)))
    base = docs.select(*row_key(), F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    return join_rows(base, found, "left").select(
        "doc_id", "text_md5", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("item_ids", F.array()).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any window of an item, with their own columns."""
    windows = Windows(docs, items)
    found = cut_lineage(find_windows(docs, windows).select("doc_id", "text_md5").distinct())
    return join_rows(whole_rows(docs), found, "left_anti").select(f"{ROW}.*")
