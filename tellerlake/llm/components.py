"""Connected components of a graph that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.session import settle


def stars(edges: DataFrame) -> DataFrame:
    """One round: larger neighbours move to the least neighbour (large star), then smaller ones (small star)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = settle(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")
    least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other node, and none hangs on a node that hangs itself."""
    upper = edges.groupBy("u").agg(F.count("*").alias("n"))
    if not upper.filter("n > 1").isEmpty():
        return False
    return edges.select(F.col("v").alias("u")).distinct().join(upper, "u", "left_semi").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node that can be reached.

    Rounds of large and small stars; every round is written to the shared folder, so lineage stays
    short. Least neighbours are combined before the shuffle and written before they are joined, so that
    Spark can split the rows of a hub.
    """
    found = settle(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    while not is_stars(found):
        found = settle(stars(found), "stars")
    roots = found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
