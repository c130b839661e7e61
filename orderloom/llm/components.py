"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import Scratch


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node it reaches) for every node of links (a, b).

    Each round points the larger neighbours of every node at its least neighbour, then
    the node itself with the smaller ones, until nothing changes; a round is written to
    the shared folder. The least neighbour is found by an aggregate that combines
    before the shuffle, so a node with very many links is no single task's group. Nulls
    and links of a node to itself are passed over; no links give no rows.
    """
    scratch = Scratch(links.sparkSession)
    edges = scratch.written(_ordered(links.select("a", "b")), "links")
    seen = _told(edges)
    while True:
        after = scratch.written(_small_star(_large_star(edges)), "stars")
        scratch.remove(edges)
        edges, before, seen = after, seen, _told(after)
        if seen == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _told(edges: DataFrame) -> tuple:
    """Number and digests of distinct edges, in whatever order; two sets agree in 128 bits by chance only."""
    digests = F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))
    return tuple(edges.agg(F.count("*"), *[F.bit_xor(d) for d in digests]).first())


def _ordered(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller node."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return _ordered(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))
