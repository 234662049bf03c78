"""Connected components of links, without collecting any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every end of the links (a, b); the component is its smallest node.

    Alternates large-star and small-star steps (Kiveris et al. 2014): each hangs a node's neighbours under the
    smallest of them, found by an aggregation that combines before the shuffle.  The rows stay as many as the
    links, and every round is written out, so lineage stays short.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = durable(hung.where("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
