"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlens.operators.joins import salted_lookup
from reviewlens.session import discard, stored


def _star(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with the smallest neighbour ``m`` of ``a``; a node with many neighbours is split."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("_n"))
    return salted_lookup(edges, least, "a", "_n").drop("_n")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``); ``root`` is the smallest node reachable.

    Each round points neighbours to smaller nodes until only stars are left, which takes a number of
    rounds logarithmic in the size of a component. Rounds are written to the shared folder, so lost
    executors cost no earlier round. No edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    while True:
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not nodes.where("up > 1 or up + down > 1").take(1):  # each node is the centre of a star or points to one
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = stored(large, "edges")
        small = _star(large)
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        small = stored(small.distinct(), "edges")
        discard(edges, large)
        edges = small
