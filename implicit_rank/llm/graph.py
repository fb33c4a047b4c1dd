"""Connected components by alternating stars on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank import session
from implicit_rank.llm import common


def _least(edges: DataFrame, name: str) -> DataFrame:
    """(node, least): the smallest of a node and its listed neighbours.

    Written out, so that a later join shuffles both of its sides and the rows
    of a node with very many edges can be split over tasks. Never broadcast: it
    has a row per node, and its files are a fraction of that.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("node"), F.least("u", "v").alias("least"))
    return session.large(common.save(least, name))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has exactly one edge, to a centre."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("centre")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("centre")))).alias("e")).select("e.*")
    per_node = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
    return not per_node.filter("child > 1 OR child = 1 AND centre = 1").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; label: the least node it reaches.

    ``edges`` are rows (u, v) of longs in any direction, repeats allowed. Each
    round joins every node with the least of its neighbourhood (large star:
    larger neighbours; small star: smaller ones), O(log n) rounds in all, until
    the edges are stars. Only that test's answer reaches the driver each round.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = common.save(edges, "cc-edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, "cc-large")
        large = (both.filter("v > u").join(least, F.col("u") == F.col("node"))
                 .select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct())
        large = common.save(large, "cc-large-edges")
        least = _least(large, "cc-small")
        joined = large.join(least, F.col("u") == F.col("node"))
        small = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
        edges = common.save(small.filter("u <> v").distinct(), "cc-small-edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
