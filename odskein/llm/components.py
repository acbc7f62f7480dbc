"""Connected components of an undirected graph, by alternating star operations.

Each round hangs the larger neighbours of every node, then the smaller ones, onto the smallest
neighbour known. Groupings are minima with partial sums; joins have one row for each node on one
side and shuffle both, so AQE can split a node with very many neighbours (see ``with_totals``). Every
round is written to the shared folder, which keeps lineage short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.llm.shared import drop_paths, reopened, stored_path
from odskein.operators.lookups import with_totals


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, root): the smallest node reachable from each node that has an edge.

    Self-loops, repeated edges and either direction are allowed; an empty table gives no rows.
    """
    spark = edges.sparkSession
    state = _oriented(edges)
    path = stored_path(state, "edges")
    state = reopened(spark, path, state)
    before = None
    while (now := _signature(state)) != before:
        before = now
        following = _small_star(_large_star(state))
        next_path = stored_path(following, "edges")
        state = reopened(spark, next_path, following)
        drop_paths(spark, path)
        path = next_path
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    hung = with_totals(both.where("b > a"), least, ["a"])
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = oriented.groupBy("a").agg(F.min("b").alias("least"))
    hung = with_totals(oriented, least, ["a"]).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
