"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Rounds of large-star and small-star steps: each node's smallest neighbour takes over its
    larger, then its smaller neighbours, until every component is a star. A step groups by
    node with partial minima and joins back, so a node of very many links is no obstacle;
    every round is a written table, and only a count and a checksum come to the driver.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = written(small_star(large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    return edges.join(least, F.col("a") == F.col("of")).select("a", "b", F.least("a", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    near = with_least(both_ways(edges))
    return near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = with_least(down)
    others = near.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(near.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
