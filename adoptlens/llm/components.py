"""Connected components by alternating star contraction (large star, small star).

Each round hangs every node on the smallest node it knows of, with a map-side minimum and one
join per half round, so a node with a third of all links is split like any skewed join. The
links between rounds are a table in the shared folder; rounds grow with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.tables import discard, stored


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    both = _both(links)
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with links to others.

    ``links`` has long columns ``a`` and ``b`` in any order; null ends, loops and repeats are
    ignored. ``component`` is the smallest node reachable.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(ordered.distinct(), "links")
    mark = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or not state[0]:
            hung = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return hung.union(hung.select(F.col("component").alias("node"), "component").distinct())
        mark = tuple(state)
        # stored, so that the join deals out both its sides itself and can split a hot node
        least = _both(links).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = stored(least, "least")
        before, links = links, stored(_small_star(_large_star(links, least)), "links")
        discard(before, least)
