"""Connected components of an edge table by alternating large-star and small-star rewiring.

Every round is a grouped minimum and a join back; no neighbour list is gathered, so a node with a third of all edges
is an ordinary hot join key with one matching row, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.session import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest node of each neighbourhood: the larger ones, or the smaller ones and the node."""
    both = edges.union(edges.select("b", "a")) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    seen = both.join(least, "a")
    if large:
        return seen.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    moved = seen.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node it is connected with.

    Self loops and repeated edges are allowed; an empty table gives an empty result.
    """
    now = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
        now = settle(_star(_star(now, True), False))
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
