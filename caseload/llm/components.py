"""Connected components of a graph given as a table of edges, by random contraction.

In each round every vertex moves to the vertex of its neighbourhood that a new random order puts first,
and edges follow their ends. A vertex that nobody moves to is gone, so a constant share of the vertices
goes in every round whatever the shape, and a long chain ends after a logarithmic number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import freeze


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of the edges (a, b); any two connected nodes have the same root.

    Edges may be repeated, in either direction or from a node to itself. No edges give no rows.
    """
    live = freeze(edges.select("a", "b").distinct())
    labels, number = None, 0
    while not live.isEmpty():
        order = F.xxhash64(F.lit(number), "b").alias("place")
        ends = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = ends.unionByName(ends.select("a", F.col("a").alias("b")))
        moved = ends.groupBy("a").agg(F.min(F.struct(order, "b")).alias("to"))
        moved = freeze(moved.select(F.col("a").alias("node"), F.col("to.b").alias("root")))
        if labels is None:
            labels = moved
        else:
            step = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = freeze(
                labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            )
        at_a = moved.select(F.col("node").alias("a"), F.col("root").alias("x"))
        at_b = moved.select(F.col("node").alias("b"), F.col("root").alias("y"))
        live = live.join(at_a, "a").join(at_b, "b").where("x <> y")
        live = freeze(live.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        number += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return labels
