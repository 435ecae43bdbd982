"""Connected components of an edge table, by alternating star contractions.

Each round points the neighbours of a node at the smallest of them, first the larger
neighbours, then the smaller ones. Long chains halve, and a hub with a third of all edges
only ever meets a one-row side: minima are partial aggregates, never collected lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import discard, written

_ROUNDS = 200


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "of")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("of", F.least("of", "least").alias("least"))
    return (
        both.join(least, F.col("u") == F.col("of"))
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = _minima(edges)
    moved = (
        edges.join(least, F.col("u") == F.col("of"))
        .filter(F.col("v") > F.col("least"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
    kept = least.select(F.col("of").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(kept).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node with an edge to a smaller component.

    ``component`` is the smallest node reachable; that node itself has no row.

    Edges may repeat, point both ways or join a node to itself; rows with a NULL end are no
    edges. Written once per round, so
    a lost executor costs one round at most.
    """
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(_ROUNDS):
        following = written(_small_star(_large_star(current)), "edges")
        mark = following.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        discard(current)
        current = following
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark
    raise RuntimeError("components did not settle")
