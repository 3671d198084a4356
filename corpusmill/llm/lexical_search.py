"""Operator 13, ranked lexical search: presence masks, highest possible score first.

The items are the queries.  A first pass over the texts counts, per document,
the terms that occur in some item; from it come N, L and the document counts,
which fix the weights.  The second pass works on blocks of documents: for each
item the bitmaps of its terms are laid beside each other, so that every document
has a mask of matched terms, and documents are grouped by mask.  A mask's
highest possible score is the sum of the largest contributions of its terms in
the block.  Masks are evaluated from the highest down, and the rest is safely
left once a mask cannot reach the item's last place so far, which is carried
from block to block.  A task returns its best documents of each item; these meet
in two steps, first apart by a hash of the document, then together.

Items are read in blocks of bounded size (``ITEM_BYTES`` of text), each with its
own two passes, so nothing that is broadcast grows with the number of items.

Defined cases: a null or empty text has no terms and no rank; a null doc_id
ranks after the other ids at equal score; repeated documents are ranked each,
repeated items reported each; an item without terms, or a table without
documents, has no rows; long texts are split into terms in pieces of a
megabyte; ties go to the smaller doc_id; columns beside (doc_id, text) and
(item_id, text) are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.text import cut_pieces, whole
from corpusmill.session import materialize

TOP = 10
#: text of the items of one block; its distinct terms are broadcast
ITEM_BYTES = 4 << 20
#: cells (term, document) of a block of documents
BLOCK_CELLS = 1 << 22
#: parts in which an item's best documents of all tasks are first brought together
SALTS = 64

_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in order."""
    for piece in cut_pieces((text or "").encode().translate(_TERM_BYTES)):
        yield piece.split()


def terms_of(text: str | None) -> list[bytes]:
    return [term for piece in _pieces(text) for term in piece]


class ItemBlock:
    """Distinct items with terms: their names, copies, and terms as places in a common list."""

    def __init__(self, rows: list, id_type: str = "bigint"):
        self.id_type = id_type
        counted = [Counter(terms_of(row["text"])) for row in rows]
        kept = [(row, terms) for row, terms in zip(rows, counted) if terms]
        self.items = [(i, row["item_id"], row["copies"]) for i, (row, _) in enumerate(kept)]
        self.place = {term: i for i, term in enumerate(dict.fromkeys(t for _, terms in kept for t in terms))}
        self.terms = [np.array([self.place[t] for t in terms], np.int64) for _, terms in kept]
        self.repeats = [np.array(list(terms.values()), np.int64) for _, terms in kept]


def item_blocks(items: DataFrame, block_bytes: int = ITEM_BYTES) -> Iterator[ItemBlock]:
    """The items, equal rows together, in blocks of about ``block_bytes`` of text."""
    distinct = items.select("item_id", "text").groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    size = distinct.agg(F.sum(F.octet_length(whole(F.col("text"))) + 64)).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    for i in range(n_blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == i
        block = ItemBlock(distinct.where(mine).collect(), items.schema["item_id"].dataType.simpleString())
        if block.items:
            yield block


def _matches(shared):
    """Rows (doc_id, n, terms, tfs): all terms of a document, and the items' terms in it with their counts."""

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.place
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).to_pylist():
                counts: Counter = Counter()
                for piece in _pieces(text):
                    counts.update(piece)
                found = [(place[t], n) for t, n in counts.items() if t in place]
                sizes.append(sum(counts.values()))
                terms.extend(t for t, _ in found)
                tfs.extend(n for _, n in found)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    return matches


def document_counts(matched: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; counted up in tasks, a number per term and task goes on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["term", "df"])

    rows = matched.select("terms").mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    counts = np.zeros(n_terms, np.int64)
    for row in rows:
        counts[row["term"]] = row["df"]
    return counts


def term_weights(counts: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in counts], np.int64)


def length_norms(sizes: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """100 - 75 + (75 n N div L); exact also where the product passes 64 bits."""
    if 75 * int(sizes.max(initial=0)) * n_docs < 2**63:
        return 25 + 75 * sizes * n_docs // max(n_all, 1)
    return np.array([25 + 75 * int(n) * n_docs // n_all for n in sizes], np.int64)


class Best:
    """The best documents of one item so far: score descending, then id ascending, null last."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def least(self) -> int:
        """A document below this score cannot enter; only scores above 0 count."""
        return max(1, int(self.scores[-1])) if len(self.scores) >= self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            scores, ids, no_id = (np.concatenate(x) for x in (
                (self.scores, scores[good]), (self.ids, ids[good]), (self.no_id, no_id[good])))
            order = np.lexsort((ids, no_id, -scores))[: self.top]
            self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


def search_block(gains: np.ndarray, ids: np.ndarray, no_id: np.ndarray, terms: np.ndarray, repeats: np.ndarray, best: Best) -> int:
    """Enter a block's documents into an item's best; returns how many were scored.

    ``gains`` has a row per term of the item with its contribution to each document.
    """
    highest = gains.max(axis=1, initial=0) * repeats
    if highest.sum() < best.least():
        return 0
    bits = np.ascontiguousarray(np.packbits(gains > 0, axis=0).T)
    masks, group = np.unique(bits.view(f"V{bits.shape[1]}").ravel(), return_inverse=True)
    matched = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1)[:, : len(terms)]
    bounds = matched.astype(np.int64) @ highest
    place = np.empty(len(masks), np.int64)
    place[np.argsort(-bounds, kind="stable")] = np.arange(len(masks))
    order = np.argsort(place[group], kind="stable")  # documents by their mask's bound, highest first
    limits = bounds[group][order]
    at, scored = 0, 0
    step = 4 * best.top
    while at < len(order) and limits[at] >= best.least():
        chosen = order[at : at + step]
        best.add(repeats @ gains[:, chosen], ids[chosen], no_id[chosen])
        at, scored, step = at + step, scored + len(chosen), 2 * step
    return scored


def _search(shared, weights, n_docs: int, n_all: int, top: int, cells: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value, weights.value
        best = [Best(top) for _ in block.items]
        step = max(64, cells // len(weight))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                ids = part.column(0).fill_null(0).to_numpy()
                no_id = part.column(0).is_null().to_numpy(zero_copy_only=False)
                norms = length_norms(part.column(1).to_numpy(), n_docs, n_all)
                terms, tfs = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64)
                at = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy())
                gains = np.zeros((len(weight), part.num_rows), np.int64)
                gains[terms, at] = weight[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * norms[at]))
                for i, mine in enumerate(block.terms):
                    search_block(gains[mine], ids, no_id, mine, block.repeats[i], best[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), [len(b.ids) for b in best]), pa.int32()),
             pa.array(np.concatenate([b.ids for b in best]), pa.int64(), mask=np.concatenate([b.no_id for b in best])),
             pa.array(np.concatenate([b.scores for b in best]), pa.int64())],
            ["item", "doc_id", "score"],
        )

    return search


def _first(rows: DataFrame, top: int, *group: str | Column) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_items(docs: DataFrame, block: ItemBlock, top: int = TOP, cells: int = BLOCK_CELLS) -> DataFrame:
    """Rows (item_id, rank, doc_id, score) of one block of items."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    matched = materialize(
        texts.mapInArrow(_matches(shared), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"), "lexical-matches"
    )
    total = matched.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.sum("n").alias("n_all")).first()
    n_docs, n_all = total["n_docs"], total["n_all"] or 0
    weights = spark.sparkContext.broadcast(term_weights(document_counts(matched, len(block.place)), n_docs))
    found = matched.mapInArrow(_search(shared, weights, n_docs, n_all, top, cells), "item int, doc_id bigint, score bigint")
    apart = _first(found, top, "item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).drop("rank")
    names = spark.createDataFrame(block.items, f"item int, item_id {block.id_type}, copies bigint")
    ranked = _first(apart, top, "item").join(F.broadcast(names), "item")
    return ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """Each item's ``top`` documents of highest score: (item_id, rank from 1, doc_id, score)."""
    found = None
    for block in item_blocks(items, block_bytes):
        part = search_items(docs, block, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    return found
