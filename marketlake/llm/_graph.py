"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._store import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every greater neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Needs a > b."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    return (edges.join(least, "a").where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.withColumnRenamed("m", "b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge, with the least node reachable as root.

    ``edges`` has long columns a and b; direction, repeats and loops don't matter. Every round
    writes its edges to the shared folder; the rounds grow with the logarithm of the size.
    Minima are combined before the shuffle, so a node with very many edges costs no task more
    than its share.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen, before = state, now
        now = written(_small_star(written(_large_star(now), "large")), "small")
        drop_written(before)
