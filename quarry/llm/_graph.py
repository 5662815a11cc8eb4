"""Connected components of a link table, by alternating stars.

Each step keeps one row per link and moves it towards the smallest node of its
neighbourhood; neighbourhoods are only ever reduced to their minimum (a partial
aggregate), never collected. A few steps suffice for any diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
            .filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return (moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .filter("a != b").distinct())


def components(links: DataFrame, scratch) -> DataFrame:
    """``(node, root)`` of every linked node; ``root`` is the smallest node it reaches.

    ``links`` has ``a, b`` (any order, repeats and loops allowed).
    """
    edges = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .filter("a != b").distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        seen = state
        edges = scratch.save(_small_star(_large_star(edges)))
