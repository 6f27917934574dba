"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the least node reachable.

    Each round rewires edges to the least neighbour with joins and partial aggregates only, and is
    staged; the number of rounds grows with the logarithm of the longest path. Loops and repeated
    edges do no harm; without edges the result is empty.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        e = stage(small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct(), "stars")
        # done when every node has one edge and no root has one
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("n"), F.lit(0).alias("r")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("n"), F.lit(1).alias("r")))
        if ends.groupBy("x").agg(F.sum("n").alias("n"), F.max("r").alias("r")).where("n > 1 OR (n = 1 AND r = 1)").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
