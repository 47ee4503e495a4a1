"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` that is not the least of its component.

    Both columns are longs; ``component`` is the least node that can be reached. Each round hangs the larger
    neighbours of every node on its least neighbour, then the smaller ones; neighbours are never gathered, only their
    minimum. A round's links are written to the shared folder, and the rounds (about the logarithm of the longest
    path) end when a round changes nothing. Repeated links and loops are allowed; no links give no rows.
    """
    # (high, low) throughout
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links"
    )
    seen = None
    while True:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select("low", "high"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        larger = larger.filter("high <> low").distinct()
        least = larger.groupBy("high").agg(F.min("low").alias("m"))
        smaller = larger.join(least, "high")
        hung = smaller.filter("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        edges = stage(hung.union(least.select("high", F.col("m").alias("low"))).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        seen = state
