"""Distributed union-find over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.store import Table

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every vertex hangs its larger (or smaller) neighbours on
    the least vertex of its neighbourhood.  The least one is a partial
    aggregate, so a hub's edges are combined before the shuffle."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every vertex of ``edges``; root is the least vertex of
    its component.

    Alternates large-star and small-star steps until the forest stays the
    same; each round is written to the shared folder, and the round before
    it is dropped.  Self-links are ignored; an empty table gives an empty
    result.  The number of rounds grows with the logarithm of the longest
    chain, and the largest table of a round with the number of edges.
    """
    spark = edges.sparkSession
    table = Table(spark, "forest").write(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where("u <> v").distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        now = table.read()
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        nxt = Table(spark, "forest").write(_star(_star(now, True), False))
        table.drop()
        table = nxt
    else:
        raise RuntimeError("components: no fixed point")
    forest = table.read()
    return forest.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        forest.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
