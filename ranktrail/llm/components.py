"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranktrail.llm.common import stored


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is the least node.

    Every round hangs each node's greater neighbours, and then its lesser ones, on the least node
    of its neighbourhood, so that star-shaped input ends after a round or two and a chain after
    a number of rounds that grows with the logarithm of its length. Neighbourhoods are
    reduced to their least node before the join, so no node's links are gathered in one group.
    Null or self links are left out.
    """
    edges = links.select(
        F.greatest("a", "b").cast("long").alias("v"), F.least("a", "b").cast("long").alias("u")
    )
    edges = stored(edges.filter(F.col("v") > F.col("u")).distinct(), f"{name}-0")
    step, before = 0, None
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m"))
        low = low.select(F.col("v").alias("x"), F.least("v", "m").alias("m"))
        low = stored(low, f"{name}-least-{step}")  # a join of two plain tables can split a busy u
        # large star: greater neighbours of x to the least node around x
        large = (
            edges.join(low, F.col("u") == F.col("x"))
            .select("v", F.col("m").alias("u"))
            .distinct()
        )
        large = stored(large, f"{name}-large-{step}")
        # small star: lesser neighbours of v to the least of them
        least = stored(large.groupBy("v").agg(F.min("u").alias("m")), f"{name}-small-{step}")
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = least.select("v", F.col("m").alias("u")).unionByName(
            small.filter(F.col("v") > F.col("u"))
        )
        edges = stored(edges.distinct(), f"{name}-{step}")
        state = edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)") + F.col("u"))).first()
        parents = edges.select("u").distinct().join(edges.select(F.col("v").alias("u")), "u", "semi")
        if state == before or parents.isEmpty() and _single(edges):
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)


def _single(edges: DataFrame) -> bool:
    """Does every node have a single parent?"""
    return edges.groupBy("v").count().filter("count > 1").isEmpty()
