"""Connected components of an edge table, by alternating large and small stars.

Each round is a grouped minimum and a join; tables are written to the shared folder
after every round. No edge and no component is ever held by the driver or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest neighbour of u or u itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest one around the node."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _least(down)
    return (starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(starred.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def connected(edges: DataFrame) -> DataFrame:
    """edges(u, v) of long nodes -> (node, root): the smallest node of its component, for
    every node that has an edge to another one. Loops, repeats and nulls are ignored."""
    edges = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        edges = stored(small_star(large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
