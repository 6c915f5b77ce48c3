"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwatch.session import discard, materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``, written.

    As a table of its own its join has a shuffle on either side, so a node with
    very many neighbours is one that adaptive execution can split.
    """
    return materialize(edges.groupBy("u").agg(F.min("v").alias("low")), "lowest")


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang every larger neighbour on the smallest node around; gives the written minima as well."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _lowest(both)
    hung = both.filter(F.col("v") > F.col("u")).join(lowest, "u")
    return hung.select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct(), lowest


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang every smaller neighbour, and the node itself, on the smallest one."""
    lowest = _lowest(edges)
    moved = (
        edges.join(lowest, "u")
        .filter(F.col("v") != F.col("low"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return moved.union(lowest.select("u", F.col("low").alias("v"))).distinct(), lowest


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node in ``edges(u, v)``; smallest id names it.

    Minima combine before each shuffle, so a node with very many neighbours
    costs one row per partition there, and written minima let the joins split it;
    every round is written to the shared folder, so a lost executor repeats one
    round at most, and the round before is deleted.
    """
    oriented = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    state = materialize(oriented.distinct(), "edges")
    seen = _fingerprint(state)
    while True:
        large, low_large = _large_star(state)
        hung = materialize(large, "hung")
        small, low_small = _small_star(hung)
        before, state = state, materialize(small, "edges")
        discard(before, hung, low_large, low_small)
        now = _fingerprint(state)
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("v").alias("id")).distinct()
    return state.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
