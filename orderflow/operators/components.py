"""Connected components of edges, in rounds that are few however long the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import stage


def _downwards(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every node of ``edges`` (``a``, ``b``); a component is named by its smallest node.

    In turn every node ties its larger neighbours, then its smaller ones, to the smallest it knows, until
    all hang on the smallest of their component: a number of rounds that grows with the logarithm of
    the longest path.  Each round is a written table.  Joins meet a node's smallest neighbour, one row
    a node, so a node of very many edges is split by the adaptive skew join.
    """
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    now, seen = stage(_downwards(edges), "components"), None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if not mark["n"] or tuple(mark) == seen:
            break
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = stage(_downwards(larger), "components")
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(_downwards(smaller.unionByName(lowest.select("a", F.col("m").alias("b")))), "components")
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(hung, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
