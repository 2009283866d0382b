"""Connected components by alternating star contractions; each round is a few joins and aggregates of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def _to_larger(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _to_smaller(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Each edge has its larger node first."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.toDF("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it reaches, ``root``, for every node of the undirected edges (a, b) but the roots.

    Edges may repeat and have either direction. Edges from a node to itself and edges with a null are dropped.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(ordered.distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_to_smaller(_to_larger(now)), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
