"""Connected components of an edge table, by alternating star contraction.

Large star hangs every larger neighbour of a node under the smallest node of
its neighbourhood; small star does the same for the smaller neighbours. Both
keep the components; they end in one star per component, whose centre is its
smallest node. Every step is a grouped minimum and an equi-join (which AQE
splits when one centre has very many neighbours), and the edges are written
to a reliable checkpoint after each round. Only two numbers per round, a
count and a checksum, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.filter("b > a").join(low, "a")
            .select(F.least("a", "m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(low, "b")
    return (joined.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(low.select(F.col("m").alias("a"), "b")))


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node
    of its component. Nodes are longs; loops and repeated edges do no harm;
    no edges give no rows."""
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = checkpoint(edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    last = state(edges)
    for _ in range(max_rounds):
        if not last[0]:
            break
        edges = checkpoint(_small_star(_large_star(edges).distinct()).distinct())
        now = state(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
            .distinct())
