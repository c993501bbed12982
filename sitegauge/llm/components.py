"""Connected components of an edge table by alternating star contraction.

Each round replaces every edge by edges to the smallest neighbour, first
towards larger nodes and then towards smaller ones, until all edges of a
component meet at its smallest node. Neighbourhoods are only ever reduced by
``min`` (combined before the shuffle), never collected, so a node that is
linked with a third of all rows is no heavier than its edge rows. Rounds grow
with the logarithm of the longest path. Every round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.tables import forget, freeze


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("m").alias("a"), "b").where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(low, "a").where("b <> m").select(F.col("m").alias("a"), "b")
    return near.unionAll(low.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected edges ``a``-``b``;
    the component is its smallest node. Self-edges, repeated edges and edges
    in both directions are fine; edges with a null end link nothing. No edges
    give an empty table."""
    now = freeze(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                 .where("a <> b").distinct(), "edges")

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last, done = mark(now), False
    while last[0] and not done:
        before, now = now, freeze(_small_star(_large_star(now)), "star")
        forget(before)
        this = mark(now)
        done, last = this == last, this
    return (now.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct())
