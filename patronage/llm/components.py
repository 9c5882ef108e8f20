"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage.llm.text import store


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of `links` (a, b).

    Links point to the smaller node. In turn each node's neighbours are hung on the smallest of
    them, first among the larger nodes, then among the smaller ones, until nothing changes; every
    round is a grouped minimum and a join, and the number of rounds grows with the logarithm of
    the graph's diameter. Each round is written to the shared folder.
    """
    edges = store(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    spark = links.sparkSession
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # hang larger neighbours on the node's minimum
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        # hang the node and its smaller neighbours on their minimum
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        edges = store(
            small.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .unionByName(least.select("a", F.col("low").alias("b")))
            .distinct(),
            "links",
        )
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == tuple(now):
            break
        mark = tuple(now)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
