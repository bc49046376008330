"""Connected components of a graph given by its edges, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable), for every node of edges(u, v).

    Union-find by alternating star contraction: a large-star step links each
    node's larger neighbours to its smallest one, a small-star step links a node
    and its smaller neighbours to the smallest. Both keep the components, and
    the graph ends as stars around the smallest nodes. Each step is an
    aggregate to one row a node and a join with it, so a node of any degree
    is combined before the shuffle, and its edges can be split in the join.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        after = written(small)
        # A forest of stars: no node has two parents, and no parent has a parent.
        parents = after.groupBy("u").agg(F.count("*").alias("n"))
        if not parents.where("n > 1").limit(1).count() and not after.select(F.col("v").alias("u")).distinct().join(parents, "u", "left_semi").limit(1).count():
            discard(now)
            break
        discard(now)
        now = after
    out = written(after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
    discard(after)
    return out
