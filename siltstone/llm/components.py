"""Connected components of an edge table, by alternating large and small stars.

Each step joins every edge with the least neighbour of its end, found by a partial aggregate, so a node with very many
edges is one row on that side and its edges can be split over tasks on the other. Steps end in the shared checkpoint
folder. Edges never outnumber the input's, and a star-shaped component is done after one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour greater than u hangs on the least of u and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours hang on the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node that has an edge; component is the least node that it reaches.

    edges: (a, b), any order and direction; loops, nulls and repeats are ignored."""
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = durable(clean)
    before, state = None, _state(now)
    while state[0] and state != before:
        before = state
        now = durable(_small_star(_large_star(now)).distinct())
        state = _state(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
