"""Connected components of a link table by alternating star contraction; every round is a few joins of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostrum.llm.fixed import saved


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], int(row[1] or 0)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the links (a, b), component being the smallest node reachable; self links and nulls are ignored.

    Larger neighbours of a node are hung on its smallest neighbour, then smaller ones likewise, until nothing changes: a number of rounds
    logarithmic in the longest path. Minima are combined before the shuffle and hot nodes are split by the adaptive join.
    """
    edges = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), label)
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        large = saved(large, label)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(small.union(low.select("a", F.col("m").alias("b"))).distinct(), label)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
