"""Connected components of a link table, as iterated DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has long columns ``a`` and ``b``; returns ``node``, ``root``
    (smallest node of its component) for every node that has a link.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    step groups by node with partial aggregation (``min``) and joins back, so
    a node with very many links is never gathered in one task. Each round is a
    written table; only its size and a checksum reach the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges, before = stage(edges, "links"), None
    while True:
        # large star: link every larger neighbour to the smallest neighbour
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")) \
            .where("hi <> lo")
        # small star: link smaller neighbours and the node itself to the smallest one
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
            F.struct("hi", F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        edges = stage(small, "stars")
        # the same links as before: every node is linked to its root
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
