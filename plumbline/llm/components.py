"""Connected components of a link table that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _least(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one least node, which itself hangs on none."""
    ends = edges.selectExpr("u AS node", "1 AS up", "0 AS top").unionByName(edges.selectExpr("v AS node", "0 AS up", "1 AS top"))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top"))
    return not nodes.agg(F.max(F.expr("up + top > 1"))).first()[0]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every linked node; the component is its least node.

    Alternates two steps that hang nodes onto ever smaller ones until all are settled,
    about log(n) times; links that already hang on their least node take none, so pairs of
    (node, component) and new links are a good start for more of them. Each result is
    written to the shared folder, so a lost executor repeats one step, and only one flag
    comes to the driver.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    while not _settled(edges):
        edges = materialize(_least(_nearest(edges).distinct()).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select("v", "v").toDF("node", "component").distinct())
