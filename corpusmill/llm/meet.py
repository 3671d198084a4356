"""Classes that share keys become links: hubs first, then only what still lies apart.

Shared by the near-duplicate operators.  A class is a distinct set; ``holders``
says which classes hold which keys (a shingle of a prefix, a band of registers).
Two sets that link share at least ``k`` keys, the smaller ``k`` of the two.

1. Every class meets one hub, the holder of one of its keys that shares most
   keys with others, as the text does that a family of copies stems from.  The
   exact check of these pairs, one per class, joins nearly all that belongs
   together; a second round does the same for what lies apart from the hub.
2. Of classes in keys whose holders are still in several components, only
   shingles that stand in two components can be shared across them.  With u of
   them, a class of n links at most with sizes up to u (100 + p) / p - n, and if
   that is below its smallest partner, with none.  So the members of a family
   that differ too much from all others never meet each other.
3. The rest meets by key and band of size, a pair at the first key it shares.
   With ``rest`` elements of a set beyond its keys, the shared keys and the
   larger ``rest`` bound what two sets can share.  One less the similarity is a
   distance, so of two classes that have met the same hub at distances x and y
   the distance is at least |x - y|.  And two sets differ in at least as many
   elements as the parities of their hashes, dealt over ``PARITY_BITS`` places,
   differ in places.  Pairs that may reach the threshold are checked exactly.

Nothing is cut: a pair is left out only if it cannot link, or if its two sides
are in one component already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import connected_components
from corpusmill.session import cut_lineage, freed_shuffles, materialize

HUB_ROUNDS = 2
#: bands of size grow by this factor
SIZE_STEP = 1.2
#: places over which a set's hashes are dealt to compare their parities
PARITY_BITS = 1024


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def _both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with all columns of both sets, named with the side."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in sets.columns if c != "node"]), side)
    return pairs


def _reaches(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n_a + n_b - shared)


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, similarity) of all pairs, exact."""
    shared = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("double")
    similarity = shared / (F.size("shingles_a") + F.size("shingles_b") - shared)
    sizes = [F.size(f"shingles_{side}").alias(f"n_{side}") for side in ("a", "b")]
    return cut_lineage(_both(pairs, sets).select("a", "b", shared.alias("shared"), *sizes, similarity.alias("similarity")))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets meet the threshold.

    Two bytes of each shingle go first: what two sets share is at most the tags
    they share and the shingles that have their tag from another one.  Whole
    sets move only for pairs that may still reach the threshold.
    """
    tag = F.transform("shingles", lambda s: F.shiftright(s, 48).cast("smallint"))
    tags = sets.select("node", F.size("shingles").cast("bigint").alias("n"), F.array_distinct(tag).alias("tags"))
    near = _both(pairs, tags)
    repeated = F.least(F.col("n_a") - F.size("tags_a"), F.col("n_b") - F.size("tags_b"))
    most = F.size(F.array_intersect("tags_a", "tags_b")) + repeated
    near = cut_lineage(near.where(_reaches(most, F.col("n_a"), F.col("n_b"), percent)).select("a", "b"))
    return linked(measured(near, sets), percent)


def linked(met: DataFrame, percent: int) -> DataFrame:
    """The measured pairs (a, b) that meet the threshold, in whole numbers."""
    return met.where(_reaches(F.col("shared").cast("bigint"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _placed(shared: DataFrame, joined: DataFrame | None) -> DataFrame:
    """Holders with their component so far, of keys that lie in several."""
    if joined is None:
        return shared.withColumn("component", F.col("node"))
    placed = shared.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = placed.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return placed.join(apart.where("_low <> _high").select("key"), "key", "left_semi")


def beside_hubs(placed: DataFrame) -> DataFrame:
    """Holders that are not in the component of their key's hub."""
    hubs = placed.groupBy("key").agg(F.max_by("component", F.struct("degree", "node")).alias("_hub"))
    return placed.join(hubs, "key").where(F.col("component") != F.col("_hub")).drop("_hub")


def hub_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """One pair (a, b) per class: with the hub that fits its size, shares enough keys and has most to share."""
    degree = F.col("degree")
    hubs = placed.groupBy("key").agg(
        F.max(F.struct(degree, F.col("node"), F.col("n"), F.col("k"), F.col("component"))).alias("hub")
    )
    met = placed.join(hubs, "key").where(
        (F.col("component") != F.col("hub.component")) & sizes_fit(F.col("n"), F.col("hub.n"), percent)
    )
    met = met.groupBy("node", "hub").agg(F.count("*").alias("shared"), F.first("k").alias("k"))
    best = met.where(F.col("shared") >= F.least("k", "hub.k")).groupBy("node").agg(F.max("hub").alias("hub"))
    return best.select(F.greatest("node", "hub.node").alias("a"), F.least("node", "hub.node").alias("b")).distinct()


def _reach(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Rows (node, low, high): the sizes a class can link with across components; none if it cannot."""
    component = placed.select("node", F.xxhash64("component").alias("c")).distinct()
    each = sets.select("node", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("s"))
    each = each.join(component, "node")
    across = each.groupBy("s").agg(F.min("c").alias("_low"), F.max("c").alias("_high")).where("_low <> _high").select("s")
    u = each.join(across, "s", "left_semi").groupBy("node", "n").agg(F.count("*").alias("u"))
    low = F.ceil(percent * F.col("n") / F.lit(100) - 1e-9)
    high = F.least(F.floor(100 * F.col("n") / F.lit(percent) + 1e-9), F.floor((100 + percent) * F.col("u") / F.lit(percent) + 1e-9) - F.col("n"))
    return u.select("node", low.alias("low"), high.alias("high")).where("low <= high")


def hub_distances(met: DataFrame) -> DataFrame:
    """Rows (node, hub, distance): the nearest class that each has met and that most have met, itself at 0."""
    sides = [met.select(F.col(x).alias("node"), F.col(y).alias("hub"), (1 - F.col("similarity")).alias("distance")) for x, y in (("a", "b"), ("b", "a"))]
    each = sides[0].unionByName(sides[1])
    meetings = each.groupBy("hub").agg(F.count("*").alias("meetings"))
    own = meetings.select(F.col("hub").alias("node"), "hub", F.lit(0.0).alias("distance"), "meetings")
    each = each.join(meetings, "hub").select("node", "hub", "distance", "meetings").unionByName(own)
    return each.groupBy("node").agg(F.max(F.struct("meetings", "hub", "distance")).alias("h")).select("node", "h.hub", "h.distance")


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.zeros((batch.num_rows, PARITY_BITS), np.uint8)
        for row, shingles in zip(rows, batch.column(1)):
            place = shingles.values.to_numpy().view(np.uint64) >> np.uint64(64 - PARITY_BITS.bit_length() + 1)
            row[:] = np.bincount(place.astype(np.int64), minlength=PARITY_BITS) & 1
        words = np.packbits(rows, axis=1).view(np.int64).ravel()
        ends = np.arange(batch.num_rows + 1, dtype=np.int32) * (PARITY_BITS // 64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(words))], ["node", "parity"])


def parities(sets: DataFrame) -> DataFrame:
    """Rows (node, parity): of each place whether an odd number of a set's hashes fall there, as 64-bit words."""
    return sets.select("node", "shingles").mapInArrow(_parities, "node binary, parity array<bigint>")


def remaining_pairs(placed: DataFrame, reach: DataFrame, distances: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that share enough keys and can reach the threshold."""
    band = lambda size: F.floor(F.log(size.cast("double")) / F.log(F.lit(SIZE_STEP)))
    held = placed.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("held"))
    able = placed.join(reach, "node").join(held, "node").join(parity, "node").join(distances, "node", "left")
    columns = ("node", "n", "k", "rest", "component", "low", "high", "held", "parity", "hub", "distance")
    apart = (F.col("hub") == F.col("hub_b")) & (F.abs(F.col("distance") - F.col("distance_b")) > 1 - percent / 100 + 1e-9)
    side = able.select("key", *columns, F.explode(F.sequence(band(F.col("low")), band(F.col("high")))).alias("band"))
    other = able.select("key", band(F.col("n")).alias("band"), *[F.col(c).alias(f"{c}_b") for c in columns])
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("n_b")) / F.lit(100 + percent) - 1e-9)
    least = F.greatest(F.least("k", "k_b"), need - F.greatest("rest", "rest_b"))
    shared = F.array_intersect("held", "held_b")
    words = [F.get(F.col("parity"), i).bitwiseXOR(F.get(F.col("parity_b"), i)) for i in range(PARITY_BITS // 64)]
    differ = reduce(Column.__add__, map(F.bit_count, words))
    return side.join(
        other,
        (side["key"] == other["key"]) & (side["band"] == other["band"])
        & (F.col("node") > F.col("node_b")) & (F.col("component") != F.col("component_b"))
        & F.col("n_b").between(F.col("low"), F.col("high")) & F.col("n").between(F.col("low_b"), F.col("high_b"))
        & ~F.coalesce(apart, F.lit(False)) & (differ <= F.col("n") + F.col("n_b") - 2 * need)
        & (F.size(shared) >= least) & (F.get(shared, 0) == side["key"]),
    ).select(F.col("node").alias("a"), F.col("node_b").alias("b"))


def link_holders(
    holders: DataFrame,
    read_sets: Callable[[DataFrame], DataFrame],
    percent: int,
    likely: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
) -> DataFrame:
    """Links (a, b) between classes that connect all that is connected.

    ``holders``: rows (key, node, n, k, rest); ``rest`` is the number of elements
    after the last one that could be a key in an order common to all sets, n
    where keys are no elements.  ``read_sets`` returns (node, shingles)
    of given nodes; ``likely`` may drop pairs of the last step before they are checked.
    """
    with freed_shuffles(holders.sparkSession):
        counts = holders.groupBy("key").agg(F.count("*").alias("holders"), F.min("k").alias("least_k")).where("holders > 1")
        shared = holders.join(counts, "key").withColumn("least_k", F.least("k", "least_k"))
        degree = shared.groupBy("node").agg(F.sum("holders").alias("degree"), F.count("*").alias("keys"), F.min("least_k").alias("_k"))
        # a class that shares fewer keys than it and all others in them need has no link
        degree = degree.where(F.col("keys") >= F.col("_k")).select("node", "degree")
        shared = materialize(shared.drop("holders").join(degree, "node"), "shared-keys")
        links: list[DataFrame] = []
        met: list[DataFrame] = []
        joined = None
        for turn in range(HUB_ROUNDS):
            placed = _placed(shared, joined)
            pairs = cut_lineage(hub_pairs(beside_hubs(placed) if turn else placed, percent))
            if pairs.isEmpty():
                break
            met.append(measured(pairs, read_sets(nodes_of(pairs))))
            links.append(linked(met[-1], percent))
            joined = connected_components(reduce(DataFrame.unionByName, links))
        placed = cut_lineage(_placed(shared, joined))
        enough = placed.groupBy("node").agg(F.count("*").alias("_keys"), F.min("least_k").alias("_k")).where(F.col("_keys") >= F.col("_k"))
        placed = placed.join(enough.select("node"), "node", "left_semi")
        sets = read_sets(placed.select("node").distinct())
        none = placed.sparkSession.createDataFrame([], "node binary, hub binary, distance double")
        distances = hub_distances(reduce(DataFrame.unionByName, met)) if met else none
        pairs = cut_lineage(likely(remaining_pairs(placed, _reach(sets, placed, percent), distances, parities(sets), percent)))
        return reduce(DataFrame.unionByName, [*links, verified(pairs, sets, percent)])


def members(documents: DataFrame, links: DataFrame) -> DataFrame:
    """Documents (with doc_id, n, node) and their (component, component_id): the smallest id reachable by links."""
    component = connected_components(links)
    per_class = documents.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least_id"))
    placed = per_class.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "component").select("node", "component", "component_id")
    return documents.join(named, "node", "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
