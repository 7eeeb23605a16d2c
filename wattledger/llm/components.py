"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.stored import stored


def connected(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """links: u, v (long). Returns node, component (the smallest node that it reaches) for
    every node that has a link to another. With `rounds` it stops after so many: `component` is
    then some node of the same component, equal for most of its nodes.

    A large star hangs a node's greater neighbours on its smallest neighbour, a small star its
    lesser ones; in a few rounds, about the logarithm of the longest path, every component is
    one star. Minima are taken in each task before the shuffle, and both sides of a join are
    plain tables, so that a node with very many links is split over tasks.
    """
    edges = stored(
        links.where(F.col("u") != F.col("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before, done = None, 0
    while done != rounds:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before, done = state, done + 1
        edges = _small_star(_large_star(edges))
    below = edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    above = edges.select(F.col("u").alias("node"), F.col("u").alias("component"))
    above = above.join(below, "node", "left_anti").distinct()
    return below.unionAll(above)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(
        both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
        "least",
    )
    moved = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("m").alias("u"), "v")
    return stored(moved.where(F.col("u") != F.col("v")).distinct(), "large")


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("v").agg(F.min("u").alias("m")), "least")
    near = edges.join(least, "v")
    moved = near.select(F.col("m").alias("u"), F.col("u").alias("v")).unionAll(
        least.select(F.col("m").alias("u"), "v")
    )
    return stored(moved.where(F.col("u") != F.col("v")).distinct(), "small")
