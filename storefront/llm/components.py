"""Connected components of a table of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import Scratch, fitted, land


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Each round every node sends its larger, then its smaller, neighbours to its least one.
    Least neighbours are found by map-side minima and met by joins that Spark may split,
    so a node with many links is not gathered anywhere. Only one row, a count and a checksum,
    comes to the driver; by the count, rounds on few links take few partitions.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    held = Scratch()
    edges, sums = held.land_observed(edges, "links", n=F.count("*"))
    n, before = sums["n"], None
    while True:
        spent, held = held, Scratch()
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = fitted(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), n)
        large = spent.land(fitted(large.distinct(), n), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select("b", "m").unionAll(least.select(F.col("a").alias("b"), "m"))
        small = fitted(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"), 2 * n)
        small = fitted(small.distinct(), 2 * n)
        edges, sums = held.land_observed(small, "links", n=F.count("*"), sum=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        spent.clear()
        n, sums = sums["n"], (sums["n"], sums["sum"])
        if sums == before:
            break
        before = sums
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    stars = fitted(stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))), 2 * n)
    stars = land(fitted(stars.distinct(), 2 * n), "components")
    held.clear()
    return stars
