"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage, freed_shuffles


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Alternates the large-star and small-star steps: each keeps every component
    connected, and they end in stars around the smallest nodes after few rounds.
    No round makes more rows than there are links.
    """
    with freed_shuffles(links.sparkSession):
        edges = cut_lineage(
            links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
        )
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
            # large star: neighbours above a node go to the smallest around it
            large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            # small star: a node and its smaller neighbours go to the smallest of them
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            after = cut_lineage(small.where("u <> v").distinct())
            same = edges.join(after, ["u", "v"], "left_semi").count()
            if same == edges.count() == after.count():
                break
            edges = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
