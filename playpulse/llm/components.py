"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.llm.scratch import cut, once


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "m")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where(F.col("b") != F.col("m"))
    return others.select(F.col("b").alias("a"), "m").union(least.select("a", "m"))


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one centre at most, and centres have none."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    with once(links.sparkSession):
        return counted.where("up > 1 or up > 0 and down > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected edges (a, b); label is its least node.

    Both steps combine map-side, and their joins take rows straight from a shuffle, so a
    node with very many edges is split. The rounds needed grow with the logarithm of the
    longest path. Edges from a node to itself are dropped; without edges there are no rows.
    """
    smaller, larger = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    links = edges.where("a <> b").select(larger, smaller)
    while True:
        links = _large_star(links).withColumnRenamed("m", "b")
        links = cut(_small_star(links).withColumnRenamed("m", "b").distinct())
        if _are_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
