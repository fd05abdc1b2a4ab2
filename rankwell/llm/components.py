"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import stored

MAX_ROUNDS = 60


def _star(near: DataFrame) -> DataFrame:
    """(u, v, m) with m the least of u and its neighbours v; minima fold in the map tasks."""
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return near.join(least, "u")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a long, b long); component: its least node.

    Large-star hangs the greater neighbours of a node on its least neighbour, small-star the
    lesser ones; the rounds end when every component is one star, after about the logarithm of
    its diameter. Each round is a stored table. Loops, repeated and null links do no harm; no
    links give no rows.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = _star(large)
        small = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            down.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u") % 1000003)).first()
        if now == mark:
            centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)
        mark = now
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
