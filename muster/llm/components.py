"""Connected components by alternating stars.

Each round points the larger neighbours of every node at the smallest node it sees (large star), then the smaller
ones (small star). Edges are read and written as tables; a node with very many neighbours meets its minimum through
an aggregate with a map-side part and a join that adaptive execution can split, never through one task's list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.plans.staging import Staging


def _star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return large.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger node a to the smaller b."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, staging: Staging, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) except the roots; a root is its component's smallest node."""
    now = staging.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    before, turn = None, 0
    state = F.struct(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.shiftright(F.xxhash64("b", "a"), 20)))
    while True:
        seen = now.agg(state.alias("s")).first()["s"]
        if seen == before or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, turn = seen, turn + 1
        now = staging.keep(_small_star(_star(now)), f"{name}{turn}")
        staging.drop(f"{name}{turn - 1}")
