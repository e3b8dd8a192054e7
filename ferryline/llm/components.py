"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """The smallest node of its component for every node with an edge: node, root.

    ``edges`` has columns a and b. In turn, every node's larger neighbours, then its
    smaller ones, are tied to the smallest node among them, until nothing changes; that
    takes a number of rounds that grows with the logarithm of the nodes. The neighbours of
    a node are never collected, and each round is written to files. So are the smallest
    neighbours, as Spark can split a node with very many edges only in a join of two plain
    shuffles.
    """
    now = staged(_oriented(edges), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = staged(_small(_large(now)), "edges")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.distinct()


def _state(edges: DataFrame) -> tuple:
    parts = F.xxhash64("a", "b")
    sums = [F.count("*"), F.sum(F.pmod(parts, F.lit(1_000_003))), F.bit_xor(parts)]
    return tuple(edges.agg(*sums).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    near = both.join(staged(least.withColumn("least", F.least("a", "least")), "least"), "a")
    return _oriented(near.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small(edges: DataFrame) -> DataFrame:
    least = staged(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    near = edges.join(least, "a")
    tied = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _oriented(tied.unionByName(least.select("a", F.col("least").alias("b"))))
