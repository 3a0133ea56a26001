"""Connected components of an edge table, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.plans.lineage import cut_lineage, let_go


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them (``a`` > ``b`` in every edge)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) of every node with an edge in ``(a, b)``.

    Each round is two joins; rounds are stored under the shared checkpoint folder
    (each is deleted when the next one stands) and end when nothing moves (about the
    logarithm of the longest chain).  Self
    loops and repeated edges are allowed; no edges give no rows.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter(F.col("a") != F.col("b")).distinct(), "cc_edges")
    before = _state(now)
    while True:
        last, now = now, cut_lineage(_small_star(_large_star(now).distinct()).distinct(), "cc_round")
        state = _state(now)
        let_go(last)
        if state == before:
            break
        before = state
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
