"""Connected components of a link table by alternating large and small stars.

Every round joins each node to the smallest node it knows, first from above,
then from below; the number of rounds grows with the logarithm of the longest
path.  A node's neighbours are only ever minimised (with a map-side step) and
joined, never gathered, so a node with very many links is no problem.  Each
round is a table under the shared checkpoint folder; the one before is removed
with its plan and shuffle files (``scratch``), so the driver does not keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges(u, v)`` with u > v -> the star step's edges, again u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(low, "u")
    if large:  # larger neighbours move to the minimum
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours and the node itself move to the minimum
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)`` for every node with a link to
    another; the component is its smallest node."""
    spark = links.sparkSession

    def mark(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    def step(e):
        with scratch(spark):
            return stage(_star(stage(_star(e, True), "large-stars"), False), "small-stars", outer=True)
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = mark(edges)
    while before[0]:
        edges = step(edges)
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
