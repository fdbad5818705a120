"""Connected components of a link table by alternating large-star and small-star steps.

Every round rewires links towards smaller ids: two aggregations by node with
map-side minima and two joins; the number of links never grows. A node with a
great many links is split by Spark's skew join, its minimum is a partial
aggregate. Rounds end when the links form stars, every node either pointing to
one smaller node or pointed at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.llm.shared import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's smallest neighbour (or itself)."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, get the smallest of them. Links come as a > b, repeats allowed."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Does every node of the distinct links (a > b) either point to one node or only get pointed at?"""
    nodes = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")) \
        .unionAll(links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return nodes.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns a, b; any order,
    self links and repeats allowed); component is its smallest node. Rows with
    a NULL end are ignored; no links give no rows."""
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "links")
    while not _are_stars(links):
        links = written(_small_star(_large_star(links)), "links")
    # a star per component: every node points to its smallest
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
