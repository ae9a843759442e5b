"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its least one. A node may have
    very many neighbours, so the least ones are written first: the join then
    reads two plain shuffles, and AQE can split such a node."""
    ends = edges.union(edges.select("v", "u"))
    least = written(ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
    return ends.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours move to the least of those."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre on another."""
    nodes = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    each = nodes.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return each.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a, b): the least node that
    it reaches. Every round writes its edges to the shared folder; rounds
    repeat until all edges form stars, which takes about the logarithm of
    their number. Loops, repeated edges and an empty table are allowed."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u != v").distinct(), "edges")
    while not _is_stars(now):
        now = written(_small_star(_large_star(now)).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v"), F.col("v")).distinct())
