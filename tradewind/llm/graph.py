"""Connected components by alternating large and small stars; edges and components never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.util import stored
from tradewind.operators.keyed import own_shuffle


def beside(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with ``m``, the least neighbour of their node ``a``. The sums are shuffled by the join itself, so that the edges of a
    node that has very many of them can be split."""
    return edges.join(own_shuffle(least, "a"), "a")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``edges`` (``a``, ``b``) but the roots.

    Each round moves all neighbours of a node to its least one, with one row per edge through joins and sums. The least neighbour
    is summed before the shuffle, and the join with it can split the edges of one node (``beside``). The rounds are about the
    logarithm of the longest path.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = beside(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = beside(large, least).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b")
        edges = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"),
                        F.expr("sum(cast(xxhash64(b, a) as decimal(38, 0)))").alias("s")).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
