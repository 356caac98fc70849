"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b``, longs;
    direction, repeats and self loops do not matter). ``component`` is the
    smallest node it can reach.

    A large star hangs each node's greater neighbours on its least neighbour; a
    small star hangs its lesser ones there. The edges shrink to one star per
    component in a number of rounds that grows with the logarithm of the graph,
    and no node's neighbours are gathered: minima are combined before the
    shuffle and joined back. Each round is written to the shared folder.
    """
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = cut(large, "large-star")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
