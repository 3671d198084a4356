"""Operator 3, n-gram Jaccard join: adaptive multi-match prefixes, verified exactly.

A document is its set of distinct shingle hashes.  Equal sets are one class, so
copies never meet each other.  Shingles that no other class has are counted
first, exactly: with u of n shared, a class links at most with sizes up to
u (100 + p) / p - n, which leaves out all that has no near duplicate.  The sets
of the rest are ordered alike, rarest shingle first.  If two sets link, their
prefixes of n - ceil(0.9 n) + k shingles share at least k.  Each set picks its
own k by estimated cost: a longer prefix makes more join rows but asks for more
shared shingles before a pair is verified.  A pair needs as many shared prefix
shingles as the smaller k of the two.

Counting unshared shingles moves 5 bytes of hash per shingle and a few per
document, packed by bucket of hashes; a shingle that several documents of one
batch have goes out once for the batch.

Holders of a prefix shingle meet as ``meet`` says: a family of near copies
costs its members, not their pairs, and yet every pair that could join two
components is tested.

Defined cases: a text that is null or has no words has no shingles and is its
own component; a null doc_id takes part but names a component only if all ids
of it are null; repeated rows are in one class; columns beside (doc_id, text)
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.meet import link_holders, members
from corpusmill.llm.text import (
    HASH_BYTES, PLAIN_SPACES, ROW, cut_pieces, hash_words, in_pieces, join_rows, mix, row_key, whole_rows,
)
from corpusmill.session import cut_lineage, freed_shuffles, materialize

SHINGLE_WORDS, PERCENT = 3, 90
#: buckets of hashes: as many as there are runs of this size in the texts, and at least some
BUCKET_BYTES, LEAST_BUCKETS = 32 << 20, 64
#: shingles packed at a time
PACK_ROWS = 1 << 21
#: longest extension of a prefix, and a verified pair's cost in join rows
MOST_MATCHES, VERIFY_COST = 6, 50.0
#: ids of documents to read again are broadcast up to this many, else joined by a shuffle
BROADCAST_IDS = 1_000_000


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place; places too near the end hold less."""
    with np.errstate(over="ignore"):
        rolled = words.copy()
        for k in range(1, width):
            left = max(0, len(words) - k)
            rolled[:left] = mix(rolled[:left] * np.uint64(0x9FB21C651E98DF25) + words[k:])
    return rolled


def _long_set(raw: bytes, width: int) -> np.ndarray:
    """The set of one text of over a megabyte: piece by piece, each after the last words of the one before."""
    found, tail = [], b""
    for piece in cut_pieces(raw.translate(PLAIN_SPACES)):
        piece = tail + b" " + piece
        words, _ = hash_words([piece])
        found.append(np.unique(_rolled(words, width)[: max(0, len(words) - width + 1)]))
        tail = b" ".join(piece.rsplit(None, width - 1)[-(width - 1) :]) if width > 1 else b""
    return np.unique(np.concatenate(found))


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    raw = [(t or "").encode().lower() for t in texts]
    for first, last in in_pieces(raw):
        if last == first + 1 and len(raw[first]) > HASH_BYTES and len(raw[first].split(None, width)) >= width:
            yield _long_set(raw[first], width)
            continue
        words, lengths = hash_words(raw[first:last])
        rolled = _rolled(words, width)
        at = 0
        for n in lengths:
            if n >= width:
                yield np.unique(rolled[at : at + n - width + 1])
            elif n:
                short = np.uint64(n)
                with np.errstate(over="ignore"):
                    for w in words[at : at + n]:
                        short = mix(np.array([short * np.uint64(0xD6E8FEB86659FD93) + w]))[0]
                yield np.array([short])
            else:
                yield words[:0]
            at += n


def set_node(shingles: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; None for the empty one."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        salt = np.uint64(0xA24BAED4963EE407)
        sums = [mix(shingles ^ np.uint64(len(shingles))).sum(), mix(shingles * salt + np.uint64(1)).sum()]
    return np.array(sums, ">u8").tobytes()


def short_node(node: bytes) -> int:
    """The first 8 bytes of a node, to count by."""
    return int.from_bytes(node[:8], "big", signed=True)


def _describe(width: int):
    """Rows (doc_id, text_md5, n, node, short) of documents."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes = [], []
            for shingles in shingle_sets(batch.column(1).to_pylist(), width):
                n.append(len(shingles))
                nodes.append(set_node(shingles))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array([x and short_node(x) for x in nodes], pa.int64())],
                ["doc_id", "text_md5", "n", "node", "short"],
            )

    return describe


PACKED = "bucket int, hashes binary, nodes binary, lengths binary, repeated binary"


def _five_bytes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five_bytes(parts: list[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, :5] = packed
    return wide.view("<u8")[:, 0]


def _pack(sets: dict[int, np.ndarray], n_buckets: int) -> Iterator[tuple]:
    """Rows of PACKED for some sets by node: each shingle with its node, or once as repeated if several have it."""
    values = np.concatenate(list(sets.values()))
    owners = np.repeat(np.fromiter(sets, np.int64, len(sets)), [len(s) for s in sets.values()])
    found, where, times = np.unique(values, return_index=True, return_counts=True)
    bucket = ((found >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
    single = times == 1
    order = np.lexsort((owners[where], single, bucket))
    found, owner, bucket, single = found[order], owners[where][order], bucket[order], single[order]
    for part in np.split(np.arange(len(found)), np.flatnonzero(np.diff(bucket)) + 1):
        once = part[single[part]]
        starts = np.flatnonzero(np.diff(owner[once], prepend=owner[once[0]] ^ 1)) if len(once) else once
        yield (
            int(bucket[part[0]]), _five_bytes(found[once]), owner[once][starts].tobytes(),
            np.diff(np.append(starts, len(once))).astype(np.int32).tobytes(), _five_bytes(found[part[~single[part]]]),
        )


def _offer(width: int, n_buckets: int):
    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("hashes", "nodes", "lengths", "repeated")]])
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for shingles in shingle_sets(batch.column(0).to_pylist(), width):
                if len(shingles):
                    held[short_node(set_node(shingles))] = shingles
                    size += len(shingles)
                if size > PACK_ROWS:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in _pack(held, n_buckets)], schema)
                    held, size = {}, 0
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in _pack(held, n_buckets)], schema)

    return offer


def _own_of_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """How many shingles of the bucket each node has alone."""
    hashes = _from_five_bytes(list(rows["hashes"]))
    owners = np.repeat(np.frombuffer(b"".join(rows["nodes"]), np.int64), np.frombuffer(b"".join(rows["lengths"]), np.int32))
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    if not len(hashes):
        return pd.DataFrame({"short": [], "own": []}, dtype="int64")
    starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    alone = np.minimum.reduceat(owners, starts) == np.maximum.reduceat(owners, starts)
    alone &= ~np.isin(hashes[starts], _from_five_bytes(list(rows["repeated"])))
    nodes, own = np.unique(owners[starts[alone]], return_counts=True)
    return pd.DataFrame({"short": nodes, "own": own})


def own_shingles(texts: DataFrame, width: int) -> DataFrame:
    """Rows (short, own): the number of shingles that no other class has, for classes with any.

    A bucket has about BUCKET_BYTES of text; what many documents share takes an
    entry per batch there.
    """
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES))
    packed = texts.select("text").mapInArrow(_offer(width, n_buckets), PACKED)
    per_bucket = packed.groupBy("bucket").applyInPandas(_own_of_bucket, "short bigint, own bigint")
    return per_bucket.groupBy("short").agg(F.sum("own").alias("own"))


def prefix_length(n: int, matches: int, percent: int = PERCENT) -> int:
    """Shingles of which a linked set shares at least ``matches``, or all that it must share."""
    return min(n, n - -(-percent * n // 100) + matches)


def choose_matches(tokens: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (node, k): the number of matches each class asks for, at the least estimated cost.

    ``tokens`` has the longest prefixes with the holders of each shingle.  With k
    matches the prefix makes the sum of other holders as join rows, and at most
    1/k of them as pairs to verify.
    """
    need = F.ceil(F.lit(percent) * F.col("n") / 100 - 1e-9)
    costs = []
    for k in range(1, MOST_MATCHES + 1):
        rows = F.sum(F.when(F.col("at") < F.col("n") - need + k, F.col("holders") - 1).otherwise(0))
        cost = F.when(F.first("n") - F.first(F.col("n") - need) >= k, rows * (1 + VERIFY_COST / k))
        costs.append(F.when(cost.isNotNull(), F.struct(cost.alias("cost"), F.lit(k).alias("k"))))
    return tokens.groupBy("node").agg(F.least(*costs)["k"].alias("k"))


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for x in shingle_sets(batch.column(0).to_pylist(), width) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_node(x) for x in found], pa.binary()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))],
                ["node", "shingles"],
            )

    return sets


def sets_of(nodes: DataFrame, texts: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """Rows (node, shingles) of the given classes, from one document each, which is read again."""
    ids = documents.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("_id")).join(nodes, "node", "left_semi")
    ids = cut_lineage(ids.select("_id").distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = texts.join(ids, texts["doc_id"].eqNullSafe(ids["_id"]), "left_semi").select("text")
    return materialize(
        chosen.mapInArrow(_sets(width), "node binary, shingles array<bigint>").dropDuplicates(["node"]), "shingle-sets"
    )


def ordered_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (node, n, at, token, holders): shingles that others have too, within the longest prefix of each class.

    A set's shingles are ordered by holders, then by hash; those that it has alone come first and are left out.
    """
    each = sets.select("node", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    listed = each.join(counts, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("s"))
    placed = listed.select("node", "n", (F.col("n") - F.size("s")).alias("_own"), F.posexplode("s").alias("_at", "s"))
    longest = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100 - 1e-9) + MOST_MATCHES
    placed = placed.select("node", "n", (F.col("_own") + F.col("_at")).alias("at"), "s.token", "s.holders")
    return placed.where(F.col("at") < longest)


def similarity_classes(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, links): rows (doc_id, text_md5, n, node) of all documents, and linked pairs of classes that
    connect all that is connected (a, b)."""
    with freed_shuffles(docs.sparkSession):
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_key()[1])
        schema = "doc_id bigint, text_md5 string, n bigint, node binary, short bigint"
        documents = materialize(texts.mapInArrow(_describe(width), schema), "shingle-counts")
        shared = F.col("n") - F.coalesce("own", F.lit(0))
        low = F.ceil(percent * F.col("n") / F.lit(100) - 1e-9)
        high = F.floor((100 + percent) * shared / F.lit(percent) + 1e-9) - F.col("n")
        able = documents.where("n > 0").join(own_shingles(texts, width), "short", "left").where(low <= high)
        able = cut_lineage(able.select("node").distinct())
        documents = documents.drop("short")
        sets = sets_of(able, texts, documents, width)
        tokens = materialize(ordered_prefixes(sets, percent), "prefix-tokens")
        in_prefix = F.col("at") < F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100 - 1e-9) + F.col("k")
        chosen = tokens.join(choose_matches(tokens, percent), "node").where(in_prefix)
        beyond = F.greatest(F.lit(0), F.ceil(F.lit(percent) * F.col("n") / 100 - 1e-9) - F.col("k"))
        holders = chosen.select(F.col("token").alias("key"), "node", "n", "k", beyond.alias("rest"))
        links = link_holders(holders, lambda nodes: sets, percent)
    return documents, links


def _members(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows (doc_id, text_md5, n, component, component_id), one per document."""
    return members(*similarity_classes(docs, width, percent))


def near_duplicate_components(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per document."""
    return _members(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _checked(keys: DataFrame) -> DataFrame:
    """Keys of rows, written, and broadcast if few enough."""
    keys = cut_lineage(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


def keep_first(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with its own columns: that with the smallest id, ids before
    null, then by the text's MD5.  Of rows equal in both one stays; texts without words all stay."""
    with freed_shuffles(docs.sparkSession):
        members = cut_lineage(_members(docs, width, percent).where("n > 0").select("doc_id", "text_md5", "component"))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_md5")
    first = members.groupBy("component").agg(F.min(key).alias("first"))
    lost = members.join(first, "component").where(key != F.col("first")).select("doc_id", "text_md5").distinct()
    lost = _checked(lost)
    again = _checked(members.groupBy("doc_id", "text_md5").count().where("count > 1").select("doc_id", "text_md5"))
    kept = join_rows(whole_rows(docs), lost, "left_anti")
    once = join_rows(kept, again, "left_anti")
    one = join_rows(kept, again, "left_semi").dropDuplicates(["doc_id", "text_md5"])
    return once.unionByName(one).select(f"{ROW}.*")
