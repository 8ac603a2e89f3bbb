"""Connected components of an edge table by repeated local contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is its least node.

    Each round moves every node to the neighbour (or itself) that comes first
    in a random order and joins what has met, which shrinks the graph by a
    constant factor.  Rounds are written tables; nothing but "is it empty"
    reaches the driver.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    first = edges
    while not edges.isEmpty():
        salt = F.lit(len(moves))
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", salt).alias("h"), F.col("b").alias("to"))).alias("m"))
        own = F.struct(F.xxhash64("a", salt).alias("h"), F.col("a").alias("to"))
        move = stored(near.select(F.col("a").alias("node"), F.least("m", own)["to"].alias("to")), "move")
        moves.append(move)
        to_a = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        to_b = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        met = edges.join(to_a, "a").join(to_b, "b").where("x <> y")
        edges = stored(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not moves:
        return first.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = reduce(_follow, moves[1:], moves[0].select("node", F.col("to").alias("root")))
    roots = stored(roots, "roots")
    least = stored(roots.groupBy("root").agg(F.min("node").alias("component")), "least")
    return roots.join(least, "root").select("node", "component")


def _follow(roots: DataFrame, move: DataFrame) -> DataFrame:
    step = move.select(F.col("node").alias("root"), "to")
    return roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
