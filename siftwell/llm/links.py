"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Each step replaces a node's neighbours by its smallest one, so paths shrink to stars in a number of rounds that
    grows with the logarithm of their length. Minima are aggregated before they are shuffled, and a node with very many
    links is met only in joins that AQE can split. Links of a node with itself are dropped.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # Large star: neighbours above a node go to the smallest of its neighbours and itself.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # From v to u holds u > v: the neighbour above v is u.
        large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(below.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        edges = cut_lineage(small)
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
