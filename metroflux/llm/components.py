"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every round points each node
to the smallest neighbour known so far, and the number of rounds grows with
the logarithm of the longest chain. The rounds end when every node points at a
node that points nowhere. Each round is written to the shared folder; the driver
sees whether there is another one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .where(F.col("a") != F.col("b"))  # an edge gives one at most, so what is twice need not be told apart here


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one other, which points to none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return seen.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("least") == 0))).agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is the smallest node of its component.

    `edges` is read twice. Edges that join every node with the smallest one of its component, and a few others, take few rounds.
    """
    now = edges.select("a", "b").where(F.col("a") != F.col("b"))
    while True:
        now = scratch.keep(_small_star(_large_star(now)), "stars")
        if _settled(now):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
