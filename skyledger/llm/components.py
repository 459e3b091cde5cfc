"""Connected components of an edge table, by hooking nodes to least neighbours and alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.tuning import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the least node that it is connected with.

    Edges with a null end are left out; loops, repeated and reversed edges do no harm. Each node first
    keeps the edge to its least neighbour only, and these edges, no more than nodes, are flattened to
    stars. Edges between stars make the same question over their labels, of which there are half as many
    nodes at most. So dense groups are looked at once and not in every round of the flattening.
    Rounds are written to the shared folder.
    """
    edges = edges.where("a is not null and b is not null and a != b")
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    least = edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("v"))
    labels = _flattened(materialize(least.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()))
    ends = [labels.select(F.col("node").alias(end), F.col("label").alias(name)) for end, name in (("u", "a"), ("v", "b"))]
    across = materialize(edges.join(ends[0], "u").join(ends[1], "v").where("a != b").select("a", "b").distinct())
    if across.isEmpty():
        return labels
    above = components(across).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return labels.join(above, "label", "left").select("node", F.coalesce("least", "label").alias("label"))


def _flattened(edges: DataFrame) -> DataFrame:
    """(node, label) of the edges (u above v).

    Every round joins each node's edges to its least neighbour, so trees flatten in a number of rounds that
    grows with the logarithm of the nodes; it ends when all edges are stars around least nodes.
    """
    while not _stars(edges):
        edges = materialize(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or only edges up."""
    ends = edges.select("u", "v").union(edges.select("v", F.lit(None)))
    ends = ends.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("n"), F.count("v").alias("down"))
    return ends.where("least != most or (down > 0 and n > down)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are joined to the least node beside or at it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least).distinct()
