"""Connected components over a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.stage import written

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b): root is the least node that it is connected to.

    Large-star: each node links its larger neighbours to its least one; small-star: its smaller ones. Repeated until the
    links are stars. A hub's links are never in one row or task: its least neighbour is an aggregate, combined before its
    shuffle, and is joined back to the links, which AQE splits for a hot hub."""
    edges = written(_ordered(links.select("a", "b")), "links")
    mark = _mark(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(_ordered(large), "large-star")
        down = edges.select(F.col("a").alias("low"), F.col("b").alias("high"))
        least = down.groupBy("high").agg(F.min("low").alias("m"))
        small = down.join(least, "high")
        small = small.select(F.col("low").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("high").alias("a"), F.col("m").alias("b")))
        edges = written(_ordered(small), "small-star")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
