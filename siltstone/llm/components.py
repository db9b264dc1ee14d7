"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import discard, materialise


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, or the node itself if it is smaller."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two long columns a and b); the root is the component's smallest node.

    Each round hangs the larger neighbours of a node on its smallest neighbour,
    then the smaller ones, so the depth falls by a logarithm. Minima are taken
    with partial aggregates; a node with very many links is never one group. Links
    with a null and links of a node to itself are left out.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small, old = large.join(_least(large), "u"), edges
        edges = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links"
        )
        discard(old)
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
