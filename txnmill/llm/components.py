"""Connected components of a table of links, in rounds that never gather one component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; the root is the smallest node that can be reached.

    Alternates two steps until the links no longer change: every node links its larger neighbours to its smallest
    neighbour, then its smaller ones. Links become stars around the roots in a number of rounds that grows with the
    logarithm of the longest path. Each round is one aggregate and one join; hot nodes are pre-aggregated, and the
    join may be split by adaptive execution.
    """
    edges = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links"
    )
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("node")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("node"))
        # Each neighbour and the node itself go to the smallest neighbour; the node's row comes with any of them.
        pairs = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("node").alias("v"), "m"))).alias("p"))
        small = pairs.select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).where("u != v").distinct()
        edges = cut_lineage(small, "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
