"""Connected components of a table of links, by alternating large and small stars.

Every round is a few grouped minima and joins over at most as many rows as there are links, cut by a reliable checkpoint. Long chains
take a logarithmic number of rounds. A node with very many links is folded by the partial minimum, and its join is one that Spark
can split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.lineage import checkpoint


#: Links in one partition; a small graph is kept in few, so that its many rounds leave few shuffle files.
LINKS = 200_000


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is the smallest node reachable."""
    links = links.select("a", "b").filter("a <> b")
    parts = math.ceil(links.count() / LINKS) or 1
    edges = checkpoint(_small(links.coalesce(parts)).coalesce(parts))
    before = _state(edges)
    while True:
        edges = checkpoint(_small(_large(edges).coalesce(parts)).coalesce(parts))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
