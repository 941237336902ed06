"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.shared import cut, let_go


def _stars(links: DataFrame) -> bool:
    """Whether all nodes of the links (a, b) are either the a of one link or the b of any."""
    ends = links.select(F.inline(F.expr("array(named_struct('node', a, 'up', 1, 'down', 0), named_struct('node', b, 'up', 0, 'down', 1))")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _round(links: DataFrame) -> DataFrame:
    ways = _both_ways(links)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
    large = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return cut(small.where("a <> b").distinct())


def roots(links: DataFrame) -> DataFrame:
    """(node, component) for each node of the links (a, b), both bigint, that is not itself the least node it can be reached from: component is that one.

    Every round replaces links by links to smaller nodes, each made from counts and minima of a
    node's links and a join that Spark can split; nothing of it comes to the driver but whether they are stars.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(links):
        links = _round(links)
        let_go(links.sparkSession)
    # stars have one link for each of these nodes
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of the links (a, b), both bigint: component is the least node it can be reached from."""
    found = roots(links)
    tops = links.where("a <> b").select(F.explode(F.array("a", "b")).alias("node")).distinct().join(found, "node", "left_anti")
    return found.unionByName(tops.withColumn("component", F.col("node")))
