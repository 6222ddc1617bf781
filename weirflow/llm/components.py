"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b,
    both long).

    Every round each node points to the smallest of itself and its neighbours,
    follows the pointers to their end, by doubling, and moves there; the edges
    move along. Only nodes smaller than all their neighbours stay, at most half
    of those that have any, so rounds and doublings are logarithmic. The moves
    of all rounds, in their order, give each node its place.
    """
    left = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    moves: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy("a").agg(F.min("b").alias("to"))
        move = _followed(cut_lineage(move.select(F.col("a").alias("node"), F.least("a", "to").alias("to"))))
        moves.append(move)
        left = (
            left.join(move.select(F.col("node").alias("a"), F.col("to").alias("new_a")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("new_b")), "b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
            .where("a <> b")
            .distinct()
        )
        left = cut_lineage(left)
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    placed = moves[0].select("node", F.col("to").alias("component"))
    for move in moves[1:]:
        step = move.select(F.col("node").alias("component"), "to")
        placed = placed.join(step, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return cut_lineage(placed)


def _followed(move: DataFrame) -> DataFrame:
    """Every pointer node -> to taken to its end, where a node points to itself."""
    while True:
        step = move.select(F.col("node").alias("to"), F.col("to").alias("next"))
        further = cut_lineage(move.join(step, "to").select("node", "to", "next"))
        move = further.select("node", F.col("next").alias("to"))
        if further.where("to <> next").isEmpty():
            return move
