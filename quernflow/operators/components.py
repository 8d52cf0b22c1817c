"""Connected components by repeated contraction, with DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.scratch import materialize


def components(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst: of one type, no nulls); nodes of one component have one root.

    Each round points every node at its first neighbour in a hashed order, follows those pointers ``jumps`` times and
    contracts what points to one place. At least half of the nodes go in a round, so rounds grow as the logarithm of the
    longest path; all minima are aggregated before the shuffle, and hubs are joins that adaptive execution can split.
    Self links and repeated links count for nothing. No edges: no rows.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("node"))
    rest = materialize(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        first = both.groupBy("src").agg(F.min(order("dst")).alias("low"))
        points = first.select(F.col("src").alias("node"), F.least(order("src"), F.col("low"))["node"].alias("root"))
        points = materialize(points, "points")
        for _ in range(jumps):
            onward = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            points = points.join(onward, "root").select("node", F.col("next").alias("root"))
        points = materialize(points, "points")
        if labels is None:
            labels = points
        else:
            onward = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            labels = materialize(labels, "labels")
        left = points.select(F.col("node").alias("src"), F.col("root").alias("a"))
        right = points.select(F.col("node").alias("dst"), F.col("root").alias("b"))
        rest = rest.join(left, "src").join(right, "dst").where("a <> b")
        rest = materialize(rest.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), "edges")
    if labels is None:
        return rest.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return labels
