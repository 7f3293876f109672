"""Connected components by alternating star operations over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Every round hangs the neighbours of each node on the smallest of them, first the larger
    ones, then the smaller ones, until all edges point at roots: a logarithmic number of
    rounds, none for edges that are stars already. Each round's edges are written to the shared folder. Minima are combined on the
    map side; the joins are plain equi-joins, whose busy nodes adaptive execution splits.
    No edges give no rows; self-edges and repeated edges do not matter.
    """
    # every edge goes from the larger to the smaller node
    current = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    while not _stars(current):
        both = current.union(current.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        larger = both.where("b > a").join(lowest, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = larger.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = larger.join(lowest, F.col("a") == F.col("u"))
        smaller = joined.select(F.col("a"), F.col("m").alias("b")).union(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        current = written(smaller, "edges")
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def _stars(edges: DataFrame) -> bool:
    """Does every larger node have one edge, to a node that is nobody's larger node?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    held = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return held.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()
