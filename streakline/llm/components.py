"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.session import stage


def _around(edges: DataFrame) -> DataFrame:
    """Every edge from each end, with ``m``, the least node next to that end or the end itself.

    Minima are merged before the shuffle and joined back, so a node with very many edges is
    a skewed join side, which is split, and never one group.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").select("a", "b", F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the least node around it."""
    return _around(edges).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``): the least node reachable.

    Edges may repeat and stand in either direction; loops and nulls are ignored. Each round is
    stored in the shared folder; the number of rounds grows with the logarithm of the nodes.
    """
    tidy = lambda e: e.where("a <> b").distinct()
    state = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = stage(tidy(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    before = state(edges)
    while before[0]:
        edges = stage(tidy(_small_star(tidy(_large_star(edges)))))
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
