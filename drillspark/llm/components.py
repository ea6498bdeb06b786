"""Connected components of an edge table by contraction: each round merges every node into one of its neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deal_lookup, drop_stored, spread_lookup, store


def components(edges: DataFrame, rounds: int = 80) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (u, v); the component is its least node. No edges give no rows.

    A node moves to the best of itself and its neighbours, and edges are carried over to where their ends have moved, until none
    is left. Best is the least id in the first two rounds, which settles stars around their least node at once, and the least
    hash, drawn anew, from then on, which shortens any chain by a share of its nodes. Every round is written to the shared
    folder; only counts come to the driver.
    """
    now = store(edges.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    count, moves = now.count(), []
    spark = edges.sparkSession
    while count:
        if len(moves) == rounds:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        best = (lambda c: F.col(c)) if len(moves) < 2 else (lambda c, turn=len(moves): F.xxhash64(c, F.lit(turn)))
        both = now.union(now.select("v", "u")).select("u", F.struct(best("v").alias("k"), F.col("v").alias("to")).alias("b"))
        near = both.groupBy("u").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n"))
        own = F.struct(best("u").alias("k"), F.col("u").alias("to"))
        moved = store(near.select(F.col("u").alias("node"), F.least("b", own)["to"].alias("to"), "n"), "moves")
        moves.append(moved)
        left = spread_lookup(now.withColumnRenamed("u", "node"), moved, "node", "n", 2 * count, F.col("v")).select(F.col("to").alias("u"), F.col("v").alias("node"))
        right = spread_lookup(left, moved, "node", "n", 2 * count, F.col("u")).select("u", F.col("to").alias("v"))
        nxt = store(right.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
        drop_stored(now)
        now, count = nxt, nxt.count()
    if not moves:
        return spark.createDataFrame([], "node bigint, component bigint")
    # where each node has gone in the end; nodes that drop out of later rounds stay where they are
    at = moves[-1].select("node", "to")
    for earlier in reversed(moves[:-1]):
        later = at.select(F.col("node").alias("to"), F.col("to").alias("end"))
        at = deal_lookup(earlier.select("node", "to"), later, "to", F.col("node"), earlier.select("to"), "left").select("node", F.coalesce("end", "to").alias("to"))
    if len(moves) <= 2:
        return at.withColumnRenamed("to", "component")
    at = store(at, "ends")
    least = at.groupBy("to").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("n"))
    return spread_lookup(at, store(least, "least"), "to", "n", at.count(), F.col("node")).select("node", "component")
