"""Operator 7, LM scoring: stupid-backoff scores against all other documents.

A word's score is the share of its context's occurrences that it follows,
c(context, word) / c(context), for the longest context with such an occurrence;
each shorter context costs a factor.  Counts are over all documents but the
scored one, or a text would vouch for itself.

Documents are dealt to blocks of bounded size.  A block counts its own n-grams,
so a frequent n-gram is one row per block, not one per place.  The count table
is partitioned by the leading bits of the n-gram's hash; there each block's rows
meet the sum over the other blocks.  Only n-grams that other blocks have too go
back to the block, where scores are summed per document.  On the way there
n-grams of one block and bucket are one row with arrays, 6 bytes and a count
each; on the way back a place in that array and a count, as the block finds the
same n-grams in the same order again.

Defined cases: a null or empty text has no words and score 0; the first word has
no context and costs no factor; a word that no other document has counts as
``UNSEEN`` occurrences; repeated rows count as separate documents; columns beside
(doc_id, text) are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.text import hash_words, in_pieces, mix, whole
from corpusmill.session import materialize

ORDER, BACKOFF, UNSEEN = 2, 0.4, 0.5
#: text of a block; a longer document makes a larger one
BLOCK_BYTES = 4 << 20
#: fewest and most leading bits of a hash that name its bucket; 48 more bits tell n-grams apart
LEAST_BITS, MOST_BITS = 10, 16


def ngram_keys(texts: list[str], order: int, bits: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text; for each order the n-grams' hashes of 48 + bits bits and the number of the text each is in."""
    raw = [t.encode().lower() for t in texts]
    parts = [hash_words(raw[first:last]) for first, last in in_pieces(raw)] or [hash_words([])]
    words, lengths = (np.concatenate(x) for x in zip(*parts))
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    keys, owners = [words], [text_of]
    for n in range(2, order + 1):
        with np.errstate(over="ignore"):
            longer = mix(keys[-1][:-1] * np.uint64(0x9FB21C651E98DF25) + words[n - 1 :]) if len(words) >= n else words[:0]
        same = text_of[: len(longer)] == text_of[n - 1 : n - 1 + len(longer)]
        # an n-gram over two texts is none; it stays in place and is left out by its owner
        keys.append(longer)
        owners.append(np.where(same, text_of[: len(longer)], np.int32(-1)))
    return lengths, [k >> np.uint64(16 - bits) for k in keys], owners


def _distinct(keys: list[np.ndarray], owners: list[np.ndarray]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """For each order the distinct hashes, which of them is at each place, and their counts; then the hashes of
    all orders sorted, and where each comes from. The texts' order does not matter to what is sorted."""
    found = [np.unique(k[o >= 0], return_inverse=True, return_counts=True) for k, o in zip(keys, owners)]
    grams = np.concatenate([k for k, _, _ in found])
    ordered = np.argsort(grams, kind="stable")
    return found, grams[ordered], ordered


def _count_block(order: int, bits: int):
    """Rows (block, bucket, mid, low, n): a block's n-grams by bucket, their hashes' lower 48 bits in two arrays."""

    def count(block: pd.DataFrame) -> pd.DataFrame:
        _, keys, owners = ngram_keys(block["text"].tolist(), order, bits)
        found, grams, ordered = _distinct(keys, owners)
        n = np.concatenate([c for _, _, c in found]).astype(np.int32)[ordered]
        bucket = (grams >> np.uint64(48)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        mid = ((grams >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
        low = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        if not len(grams):
            return pd.DataFrame({"block": [], "bucket": [], "mid": [], "low": [], "n": []}, dtype=object)
        return pd.DataFrame({
            "block": block["block"].iloc[0], "bucket": bucket[np.concatenate(([0], cuts))],
            "mid": np.split(mid, cuts), "low": np.split(low, cuts), "n": np.split(n, cuts),
        })

    return count


def _counts(owners: np.ndarray, where: np.ndarray, everywhere: np.ndarray) -> np.ndarray:
    """For each place its n-gram's count outside the place's own text; 0 where there is no n-gram."""
    real = owners >= 0
    pair = where.astype(np.int64) * (int(owners.max(initial=0)) + 1) + owners[real]
    _, inverse, own = np.unique(pair, return_inverse=True, return_counts=True)
    out = np.zeros(len(owners), np.int64)
    out[real] = everywhere[where] - own[inverse]
    return out


def _unpack(shared: pd.DataFrame, grams: np.ndarray) -> np.ndarray:
    """Counts in other blocks of a block's sorted n-grams; 0 for those that did not come back."""
    none = np.zeros(0, np.int32)
    sizes = np.fromiter(map(len, shared["at"]), np.int64, len(shared))
    first = np.searchsorted(grams, shared["bucket"].to_numpy(np.uint64) << np.uint64(48))
    places = np.repeat(first, sizes) + np.concatenate([none, *shared["at"]])
    others = np.zeros(len(grams), np.int64)
    others[places] = np.concatenate([none, *shared["upper"]]).astype(np.int64) << 31 | np.concatenate([none, *shared["others"]])
    return others


def _score_block(order: int, bits: int):
    def score(block: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        lengths, keys, owners = ngram_keys(block["text"].tolist(), order, bits)
        found, grams, ordered = _distinct(keys, owners)
        others = np.empty(len(grams), np.int64)
        others[ordered] = _unpack(shared, grams)
        others = np.split(others, np.cumsum([len(k) for k, _, _ in found])[:-1])
        words = len(keys[0])
        counts = [_counts(o, where, n + out) for o, (_, where, n), out in zip(owners, found, others)]
        text_of = owners[0]
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else np.zeros(0, np.int64)
        place = np.arange(words) - starts[text_of]  # of the word in its text
        # the number of all other words is divided out by the caller, who knows it then
        value = np.log(np.where(counts[0] > 0, counts[0], UNSEEN))
        used = np.ones(words, np.int64)
        for n in range(2, order + 1):
            if words < n:
                break
            here = np.zeros(words, np.int64)
            here[n - 1 :] = counts[n - 1]
            context = np.ones(words, np.int64)
            context[n - 1 :] = counts[n - 2][: words - n + 1]
            seen = (place >= n - 1) & (here > 0)
            value[seen] = np.log(here[seen] / context[seen])
            used[seen] = n
        longest = np.minimum(place + 1, order)
        value += (longest - used) * np.log(BACKOFF)
        sums = np.bincount(text_of, value, len(lengths))
        backed = np.bincount(text_of, used < longest, len(lengths)).astype(np.int64)
        return pd.DataFrame({
            "doc_id": block["doc_id"], "n_words": lengths, "n_backed_off": backed,
            "n_unigram": np.bincount(text_of, used == 1, len(lengths)).astype(np.int64), "log_sum": sums,
        })

    return score


def lm_scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (doc_id, n_words, n_backed_off, log_score, mean_log_score), one per document."""
    texts = docs.select("doc_id", whole(F.col("text")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = -(-size // block_bytes) + 1
    # a function of the row, so a repeated task deals alike; repeated rows share a block
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    dealt = dealt.select("doc_id", "text", "block")
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(4 * blocks))))
    packed = dealt.groupBy("block").applyInPandas(
        _count_block(order, bits), "block int, bucket int, mid array<smallint>, low array<int>, n array<int>"
    )
    table = packed.repartition("bucket").select(
        "block", "bucket", F.posexplode(F.arrays_zip("mid", "low", "n")).alias("at", "g")
    ).select("block", "bucket", "at", "g.mid", "g.low", "g.n")
    # a row per block and n-gram: the group of one n-gram is at most the number of blocks
    everywhere = F.sum(F.col("n").cast("bigint")).over(Window.partitionBy("bucket", "mid", "low"))
    others = everywhere - F.col("n")
    shared = (
        table.withColumn("others", others)
        .where("others > 0")
        # at most a block's n-grams of one bucket; a count in two halves, the upper one of which is nearly always 0
        .select("block", "bucket", F.struct(
            "at", F.col("others").bitwiseAND(F.lit(2**31 - 1)).cast("int").alias("others"),
            F.shiftright("others", 31).cast("int").alias("upper"),
        ).alias("g"))
        .groupBy("block", "bucket")
        .agg(F.collect_list("g").alias("g"))
        .select("block", "bucket", F.col("g.at").alias("at"), F.col("g.others").alias("others"), F.col("g.upper").alias("upper"))
    )
    # one plan for both, so the exchange of texts is written once
    scored = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        _score_block(order, bits), "doc_id bigint, n_words bigint, n_backed_off bigint, n_unigram bigint, log_sum double"
    )
    scored = materialize(scored, "lm-sums")
    total = scored.agg(F.sum("n_words")).first()[0] or 0
    rest = F.ln(F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)).cast("double"))
    log_score = (F.col("log_sum") - F.col("n_unigram") * rest).alias("log_score")
    return scored.select("doc_id", "n_words", "n_backed_off", log_score).withColumn(
        "mean_log_score", F.col("log_score") / F.greatest("n_words", F.lit(1))
    )
