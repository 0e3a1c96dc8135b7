"""Connected components by alternating star contraction, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node of ``links``.

    Every round links all of a node's larger neighbours to its least one, then
    all of its smaller ones to the least; rounds, logarithmic in number, go on
    until nothing changes.  Each round is a table in the shared folder, and no
    task holds a node's neighbours.  Links with a null end, self-links and
    repeats don't matter; an empty table gives no row.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v and u is not null and v is not null").distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        # Large star: u's neighbours above it point to the least of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "edges")
        # Small star: u's lesser neighbours, and u, point to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        old, edges = edges, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(old, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    rooted = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(rooted.select(F.col("root").alias("node"), "root").distinct())
