"""Connected components of a table of links, by alternating star contractions.

Every round points each node at the smallest node it can see: first its larger neighbours go to its
smallest neighbour, then its smaller ones do. Stars remain, whose centre is the smallest node of the
component. A round is two grouped minima and two joins over the links; the number of rounds grows
with the logarithm of the longest path. A hub is one row per link, never one group in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.frames import staged


def _contract(directed: DataFrame) -> DataFrame:
    """``directed`` (u, v) with m, the least node around u.

    The minima are dealt anew before the join: both sides then come straight from a shuffle, and
    Spark can split the partition of a hub.
    """
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least.hint("rebalance"), "u")


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Links are undirected; loops, repeats and nulls (which link nothing) are fine. Without links the
    result is empty.
    """
    edges = (
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    edges = staged(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _contract(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _contract(large.where("u <> v").distinct())
        edges = staged(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "links",
        )
        # Stars at last: every node hangs on one centre, and no centre hangs on another.
        hangs = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        hung_on = edges.select(F.col("v").alias("u")).distinct().withColumn("n", F.lit(1).cast("bigint"))
        if hangs.unionByName(hung_on).groupBy("u").agg(F.sum("n").alias("n")).where("n > 1").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
