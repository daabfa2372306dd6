"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("x").alias("u"), F.col("y").alias("v")).union(edges.select("y", "x"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("x"), F.col("m").alias("y")).where("x <> y").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("x"), F.col("m").alias("y"))
    return rest.union(least.select("u", "m")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (x, y; x <> y): root is the
    smallest node reachable. Rounds go on until the edges no longer change;
    each is written to the shared folder, where it takes the place of the one
    before, and a node of many edges is a partial minimum and a join, never a
    gathered group."""
    edges, path = shared.replaced(edges.distinct(), "links")
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        edges, path = shared.replaced(_small_star(_large_star(edges)), "links", path)
    return (edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
            .union(edges.select("y", "y")).distinct())
