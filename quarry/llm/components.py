"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    out = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = (edges.join(least, F.col("a") == F.col("u")).filter("b > m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component: its least node.

    Loops and null ends are ignored.  Minima are combined before each shuffle
    and each round is written to the shared folder, so neither a hub nor a lost
    executor hurts.  A long chain shrinks by a constant factor each round.
    """
    edges = cut(edges.filter("a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        edges = cut(_small_star(_large_star(edges)))
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
