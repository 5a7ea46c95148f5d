"""Connected components of an edge list by alternating stars.

Each round links every node's larger neighbours to its smallest one (large star) and then its
smaller neighbours to the smallest (small star); rounds end when every edge leads to the centre of a
star, which one grouping of the ends tells (edges that are stars to begin with, or none, take no round).
Neighbour minima are aggregations with partial sums, and come back by a join in which the aggregated side has one row
for a node, so a node with a third of all edges is split like any other skewed join. Each round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialize


def _stars(e: DataFrame) -> bool:
    """Whether distinct edges from larger to smaller nodes are stars: no node has two edges to smaller
    ones, and none that has one is another's smaller one."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    met = ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("least"))
    return met.where("n > 1 OR n = 1 AND least = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): component is its smallest reachable
    node. Nodes are non-null bigints; self-loops, repeated and reversed edges are fine."""
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
                    "cc")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every edge of `large` has a > b already
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "cc")
    ends = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
