"""Connected components of a table of links by alternating star contractions.

Each round joins the links with the smallest neighbour of each node, first among all neighbours,
then among the smaller ones, until every component is a star; the number of rounds grows with the
logarithm of the largest component. All steps are groupings with map-side combining and joins; the
minima are written first, so their size is known to the join and a hub's rows can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.staging import stage


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
    return seen.where("up > 1 OR (up = 1 AND low = 0)").isEmpty()


def _to_minimum(pairs: DataFrame, label: str) -> DataFrame:
    """``pairs`` (u, v) with m: the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(stage(least, label), "u")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), longs; component is the smallest node.

    Nulls and loops link nothing. Without links the result is empty.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(clean.distinct(), "links")
    while not _are_stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _to_minimum(both, "large-star").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-links")
        starred = _to_minimum(large, "small-star")
        lower = starred.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        own = starred.select(F.col("u").alias("a"), F.col("m").alias("b"))
        edges = stage(lower.unionByName(own).distinct(), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
