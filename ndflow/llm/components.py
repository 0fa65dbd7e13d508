"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.frames import stored


def components(edges: DataFrame, spark: SparkSession, label: str = "cc") -> DataFrame:
    """``node, component`` (smallest node of its component) of every node of
    ``edges(a, b)``, by alternating large-star and small-star steps.

    Each step links a node's neighbours to their smallest node, so the number
    of steps grows with the logarithm of the size; every step is one or two
    aggregates over the edges, written to the shared folder.  A node with many
    neighbours is no single task: minima are combined before the shuffle."""
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), spark, label)
    while True:
        # large star: every larger neighbour of a node goes to the node's minimum
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        large = e.join(low, e["a"] == low["n"]).select(F.col("m").alias("a"), "b").distinct()
        # small star: a node and its smaller neighbours go to the smallest
        low = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
        x = large.join(low, large["b"] == low["n"])
        small = x.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b").unionAll(low.select(F.col("m").alias("a"), F.col("n").alias("b")))
        nxt = stored(small.distinct(), spark, label)
        # done when every node has one edge, and it leads to a node with none below it
        roots = nxt.select(F.col("a").alias("r")).distinct()
        open_ = (nxt.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
                 or nxt.join(roots, nxt["b"] == roots["r"], "left_semi").limit(1).count())
        e = nxt
        if not open_:
            break
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
