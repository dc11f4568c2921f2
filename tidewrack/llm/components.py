"""Connected components of an edge table by alternating large and small stars.

Every half round is an aggregation and a join over the edges; they are staged in the shared
checkpoint folder, and nothing reaches the driver but whether a round was the last. The
number of rounds grows with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` -> ``(node, label)``, label = smallest node reachable. Edges may repeat
    and may join a node with itself; nodes are not null and appear if they have another
    neighbour than themselves.

    A round hangs every node's larger neighbours on its smallest one (large star), then
    joins the smaller neighbours of every node (small star); both keep the connectivity.
    The rounds end when every node has one edge, to a node that has none: stars around the
    smallest nodes."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    e = stage(e, "cc-edges")
    while not are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = stage(large.distinct(), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        e = stage(small.select("x.u", "x.v").where("u > v").distinct(), "cc-small")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def are_stars(e: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller neighbour that has one."""
    nodes = e.select("u", F.lit(1).alias("own"), F.lit(0).alias("inner")).unionByName(e.select(F.col("v").alias("u"), F.lit(0).alias("own"), F.lit(1).alias("inner")))
    return nodes.groupBy("u").agg(F.sum("own").alias("own"), F.max("inner").alias("inner")).where("own > 1 OR own + inner > 1").isEmpty()


def with_edges(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels after more edges. Only the labels that these edges join are worked on."""
    named = edges
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(f"n_{end}"), F.col("label").alias(f"l_{end}"))
        named = named.join(own, F.col(end) == F.col(f"n_{end}"), "left")
    named = named.select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b"))
    stars = connected_components(named)
    to = stars.select(F.col("node").alias("s_node"), F.col("label").alias("s_label"))
    old = labels.join(to, F.col("label") == F.col("s_node"), "left").select("node", F.coalesce("s_label", "label").alias("label"))
    new = stars.join(labels.select(F.col("node").alias("s_node")), F.col("node") == F.col("s_node"), "left_anti")
    return stage(old.unionByName(new), "cc-labels")
