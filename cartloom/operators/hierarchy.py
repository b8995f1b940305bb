"""Parent-child trees of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators.groups import attach
from cartloom.session import durable


def walk(nodes: DataFrame, node: str, parent: str, label: str, separator: str = " > ") -> DataFrame:
    """Depth and path of every node; a root is a node without parent.

    Pointer doubling: every node knows the path from some ancestor (at first its parent)
    down to itself, and each round takes over what that ancestor knows, which doubles
    the distance. A tree of depth d needs about log2(d) rounds, each one join of the nodes
    that have not reached their root, and the result is one stored table. An ancestor
    that very many nodes point at is served by several tasks. Rounds are written to
    shared storage, which keeps the plan short and survives a lost executor.

    Repeated ids are refused, and so are nodes that no root reaches: their parents form
    a cycle or are missing.
    """
    given = nodes.select(F.col(node).alias("_node"), F.col(parent).alias("_up"), F.col(label).alias("_path"))
    state = durable(given.withColumns({"_label": F.col("_path"), "_steps": F.lit(0).cast("bigint"), "_lost": F.lit(False)}))
    if not state.groupBy("_node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError("a node is listed more than once")
    going = F.col("_up").isNotNull() & ~F.col("_lost")
    before, left = None, state.filter(going).count()
    # every round settles some node of a tree; when none is settled, cycles are all that is left
    while left and left != before:
        open_ = state.filter(going)
        asked = open_.groupBy("_up").agg(F.count(F.lit(1)).alias("_children"))
        # what an ancestor knows, for each one that is asked; a missing one makes its nodes lost
        known = state.select(F.col("_node").alias("_up"), F.col("_up").alias("_next"), F.col("_path").alias("_above"), F.col("_steps").alias("_more"), F.col("_lost").alias("_gone"))
        known = durable(asked.join(known, "_up", "left").withColumn("_gone", F.coalesce("_gone", F.lit(True))))
        met = attach(open_, known, ["_up"], "_children", ["_node"])
        moved = met.select(
            "_node",
            F.col("_next").alias("_up"),
            F.concat_ws(separator, "_above", "_path").alias("_path"),
            "_label",
            (F.col("_steps") + F.col("_more") + 1).alias("_steps"),
            F.col("_gone").alias("_lost"),
        )
        state = durable(state.filter(~going).unionByName(moved))
        before, left = left, state.filter(going).count()
    lost = state.filter(F.col("_up").isNotNull() | F.col("_lost")).count()
    if lost:
        raise ValueError(f"no root reaches {lost} nodes: their parents form a cycle or are missing")
    return state.select(
        F.col("_node").alias(node),
        F.col("_label").alias(label),
        F.col("_steps").alias("depth"),
        F.col("_path").alias("path"),
        F.concat(F.repeat(F.lit("  "), F.col("_steps").cast("int")), F.col("_label")).alias("indented"),
    )
