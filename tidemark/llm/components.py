"""Connected components of a table of links, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import store


def _least(edges: DataFrame) -> DataFrame:
    """Least neighbour of each node ``u``, itself included."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each linked node can reach.

    Two steps alternate until nothing changes: a node's larger neighbours are tied
    to its least one, then its smaller ones are. Each round makes trees flatter, and
    the number of rounds grows as the logarithm of the longest path. Joins carry
    rows (node, neighbour), and a hub's rows are split by Spark's skew join.
    """
    both = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = store(both.where("u <> v").distinct(), "links")
    before = None
    while True:
        # larger neighbours to the least one
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = around.join(_least(around), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # then each node and its smaller neighbours
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = store(small.where("u <> v").distinct(), "links")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
