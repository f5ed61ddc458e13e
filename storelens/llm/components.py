"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (two long columns ``a, b``); the root is the
    smallest node that can be reached. Isolated nodes have no edge and don't appear.

    A large star links the larger neighbours of a node to the smallest one, a small star the
    smaller ones; both keep components and never add edges. Neighbours are only aggregated and
    joined, never gathered, so that a node may have any number of them. Each round is written to
    the shared folder and the one before it deleted.
    """
    links = stored(edges.filter(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(links)
    while True:
        before, links = links, stored(_small_star(_large_star(links)), "links")
        discard(before)
        now = _state(links)
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct())
        state = now


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    return (both.filter(F.col("v") > F.col("u"))
            .join(least, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.least("m", "n").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    moved = (links.join(least, F.col("u") == F.col("n")).filter(F.col("v") != F.col("m"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(least.select("n", "m")).distinct()
