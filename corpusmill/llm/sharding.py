"""Operator 4, sharding: a hierarchical weighted hash tree.

The tree has regions, racks and shards.  A row descends it: at each level every
child draws ``-ln(u) / weight`` from a hash of (key, child) and the smallest draw
wins, so children get rows in proportion to their weights, and a change of one
child's weight moves rows only into or out of that child.  A tree is laid out
for ``BASE_SHARDS`` shards; every later shard joins as a region of its own, so
one more shard changes no weight but its own and takes rows only into itself.
The law is therefore ``key``: doc_id and shard count decide.

Defined cases: a null doc_id is a key like any other; a null text has size 16
and the CRC of no bytes, 0; repeated rows get the same shard and different
slots; columns beside (doc_id, text) are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.text import mix, whole
from corpusmill.session import materialize

#: racks of a full region and shards of a rack
RACKS, SHARDS = 5, 4
#: shards for which regions and racks are laid out; later ones stand alone
BASE_SHARDS = 40
ROW_BYTES = 16


def build_tree(n_shards: int, base: int = BASE_SHARDS) -> list[tuple[str, float, list]]:
    """Nested (name, weight, children) of a shard count; a leaf carries its shard number instead of children."""
    if n_shards < 1:
        raise ValueError("at least one shard")
    regions: dict[str, dict[str, list]] = {}
    for shard in range(n_shards):
        rack = shard // SHARDS
        region, rack = (f"r{rack // RACKS}", f"k{rack}") if shard < base else (f"solo{shard}", "k")
        regions.setdefault(region, {}).setdefault(f"{region}/{rack}", []).append((f"s{shard}", 1.0, shard))
    tree = []
    for region, racks in regions.items():
        below = [(rack, float(len(leaves)), leaves) for rack, leaves in racks.items()]
        tree.append((region, sum(weight for _, weight, _ in below), below))
    return tree


def _name_code(name: str) -> np.uint64:
    code = 0xCBF29CE484222325
    for byte in name.encode():
        code = (code ^ byte) * 0x100000001B3 % 2**64
    return np.uint64(code)


def descend(keys: np.ndarray, children: list) -> np.ndarray:
    """Shard of each 64-bit key below these children."""
    draws = np.empty((len(children), len(keys)))
    for i, (name, weight, _) in enumerate(children):
        u = ((mix(keys ^ mix(_name_code(name)[None])) >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
        draws[i] = -np.log(u) / weight
    chosen = draws.argmin(axis=0)
    out = np.empty(len(keys), np.int32)
    for i, (_, _, below) in enumerate(children):
        mine = chosen == i
        if mine.any():
            out[mine] = descend(keys[mine], below) if isinstance(below, list) else below
    return out


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard 0..n_shards-1 of a bigint key; the key and the count decide, nothing else."""
    if n_shards > RACKS * SHARDS and n_shards // (RACKS * SHARDS) != (n_shards + 1) // (RACKS * SHARDS):
        # the next shard would turn single regions into a full one
        raise ValueError(f"a count of {n_shards} cannot grow by one without regrouping")
    return _shards(n_shards, n_shards)(key)


def grown_shard_of(key: Column, n_shards: int) -> Column:
    """The shard after one more shard is added to a tree of ``n_shards``."""
    return _shards(n_shards, n_shards + 1)(key)


def shard_of(n_shards: int, base: int = BASE_SHARDS):
    """Column function: shard 0..n_shards-1 of a non-null bigint key."""
    tree = build_tree(n_shards, base)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(descend(mix(keys.to_numpy().astype(np.int64).view(np.uint64)), tree))

    return place


def assign_shards(docs: DataFrame, n_shards: int = 40, base: int = BASE_SHARDS) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Slots count through a shard's rows by input part: within a part by a window
    that never holds more than one part's rows of one shard, across parts by a
    running sum over counts.
    """
    text = whole(F.col("text"))
    key = F.xxhash64("doc_id")
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
        key.alias("_key"),
    ).select("*", shard_of(n_shards, base)("_key").alias("shard"), shard_of(n_shards + 1, base)("_key").alias("grown_shard"))
    # row numbers are fixed by writing them, so a lost task cannot number rows anew
    stored = materialize(placed.drop("_key"), "placed").withColumn("_part", F.shiftright("_row", 33))
    counts = stored.groupBy("shard", "_part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_row"))
    return (
        stored.withColumn("_inside", inside)
        .join(before, ["shard", "_part"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("before") + F.col("_inside") - 1).alias("slot"), "grown_shard")
    )
