"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _is_stars(e: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one or none, and none has both kinds."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to (node, component): the smallest node that
    can be reached, for every node of an edge.

    Each round hangs a node's larger neighbours on its smallest neighbour
    (large star), then its smaller ones (small star), until every edge ends at its
    component's smallest node. Neighbour minima are pre-aggregated and joined
    back, so a hub is neither collected nor joined to itself."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u > v").distinct(), "cc")
    while not _is_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join reads plain exchanges, whose hot keys Spark can split.
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = (e.withColumnRenamed("u", "w").withColumnRenamed("v", "u").join(low, "u")     # v < w hangs w on v's minimum
                 .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "cc-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u > v").distinct())
        e = written(small, "cc")
    roots = e.groupBy("v").agg(F.lit(1)).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
