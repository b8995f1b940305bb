"""Connected components as alternating star contractions on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import attach, durable


def _star(edges: DataFrame, total: int) -> DataFrame:
    """Point every neighbour ``v`` of ``u`` at the smallest node of the neighbourhood of ``u``.

    ``edges`` holds (u, v) rows and is stored, ``total`` is about their number. The centre of a large group has very
    many rows; its minimum comes from partial sums and returns by ``attach``.
    """
    low = durable(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count("*").alias("n")))
    return attach(edges, low, ["u"], "n", total=total)


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node, component`` for every node of ``edges`` (two columns ``a, b`` of one ordered type).

    The component is the smallest id that can be reached. Large-star and small-star
    rounds (each one aggregation and one join) run until the edges no longer change;
    their number grows with the logarithm of the node count. Loops, repeated edges and
    NULL ends are ignored; no edges give no rows.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = durable(pairs.distinct())
    mark = _mark(state)
    while mark[0]:
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, 2 * mark[0]).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = durable(large.where("u <> v").distinct())
        near = _star(large, mark[0])
        small = near.select(F.col("v").alias("u"), F.col("low").alias("v")).union(near.select("u", F.col("low").alias("v")))
        state = durable(small.where("u <> v").distinct())
        now = _mark(state)
        if now == mark:
            break
        mark = now
    roots = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())
