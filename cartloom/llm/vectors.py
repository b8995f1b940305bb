"""Embedding near-dedup: cover trees walked in pairs, with exact pairs above a cosine threshold."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cartloom.llm.common import attach, durable, query, table
from cartloom.llm.graph import components

THRESHOLD = 0.98
#: Vectors of one leaf that a task compares, children of a split, and levels of halving radii.
LEAF, FAN, DEPTH = 1024, 64, 7
SLACK = 1e-9


def _reach(threshold: float) -> float:
    """Distance between unit vectors at that cosine."""
    return math.sqrt(2.0 - 2.0 * threshold)


def _unit(values: list | None) -> np.ndarray | None:
    """The vector at length one in double precision; None for one that links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or not np.isfinite(x).all() or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots, classes, units = [], [], []
        for vec_id, label, values in zip(*[c.to_pylist() for c in batch.columns]):
            u = _unit(values) if label is not None and vec_id is not None else None
            roots.append(None if u is None else f"{label}/{len(u)}")
            units.append(None if u is None else u.tobytes())
            classes.append(None if u is None else hashlib.sha256(roots[-1].encode() + np.array(values, np.float64).tobytes()).digest()[:20])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roots, pa.string()), pa.array(classes, pa.binary()), pa.array(units, pa.binary())], ["vec_id", "root", "cls", "unit"])


class CoverTree:
    """Nested levels with halving radii over a few unit vectors.

    Every node has a centre among the vectors, its members, and its covering radius;
    its children are the greedy net of its members at half the level's radius.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[list[int]] = []
        todo = [(self._node(np.arange(len(x)), 0), 1.0)]
        while todo:
            k, radius = todo.pop()
            if len(self.members[k]) == 1:
                continue
            left = self.members[k]
            if self.radius[k] < 1e-7:  # equal but for rounding: a level of single vectors
                self.children[k] = [self._node(left[i : i + 1], left[i]) for i in range(len(left))]
                continue
            while radius >= self.radius[k]:  # levels at which the node is its own only child
                radius /= 2
            centre = self.centre[k]
            while len(left):
                far = self._far(left, centre)
                near = far <= radius
                child = self._node(left[near], centre)
                self.children[k].append(child)
                todo.append((child, radius / 2))
                left = left[~near]
                centre = left[0] if len(left) else centre

    def _far(self, members: np.ndarray, centre: int) -> np.ndarray:
        d = self.x[members] - self.x[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _node(self, members: np.ndarray, centre: int) -> int:
        self.centre.append(int(centre))
        self.members.append(members)
        self.radius.append(float(self._far(members, centre).max()) if len(members) > 1 else 0.0)
        self.children.append([])
        return len(self.centre) - 1


def walk(a: CoverTree, b: CoverTree, threshold: float):
    """Linked pairs between two trees (or within one, given twice) as index pairs ``(i, j)``.

    Yields arrays ``(left, right, whole)``: with ``whole`` every left one links with
    every right one, else they are pairs position by position. Node pairs whose covering
    balls are further apart than the threshold are pruned; balls that lie within it as
    a whole are not opened.
    """
    reach, same = _reach(threshold), a is b
    todo = [(0, 0)]
    while todo:
        p, q = todo.pop()
        ps, qs = a.children[p] or [p], b.children[q] or [q]
        ci, cj = [a.centre[k] for k in ps], [b.centre[k] for k in qs]
        ri, rj = np.array([a.radius[k] for k in ps]), np.array([b.radius[k] for k in qs])
        cos = a.x[ci] @ b.x[cj].T
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))
        both = ri[:, None] + rj[None, :]
        single = np.outer([len(a.members[k]) == 1 for k in ps], [len(b.members[k]) == 1 for k in qs])
        open_ = apart <= both + reach + 1e-6
        if same and p == q:
            open_ &= ~np.tri(len(ps), len(qs), -1, dtype=bool)
        linked = open_ & single & (cos >= threshold)
        if same and p == q:
            linked &= ~np.eye(len(ps), dtype=bool)
        i, j = np.nonzero(linked)
        if len(i):
            yield np.array(ci)[i], np.array(cj)[j], False
        for i, j in zip(*np.nonzero(open_ & ~single)):
            if (not same or ps[i] != qs[j]) and apart[i, j] + both[i, j] <= reach - 1e-6:
                yield a.members[ps[i]], b.members[qs[j]], True
            elif (p, q) != (ps[i], qs[j]):
                todo.append((ps[i], qs[j]))


def _compare(threshold: float):
    """For one pair of blocks: links counted per vector, and edges that keep them connected."""

    def run(rows: pa.Table) -> pa.Table:
        node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
        x = np.array([np.frombuffer(u, np.float64) for u in rows["unit"].to_pylist()])
        side = rows["side"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        a = CoverTree(x[left])
        b = a if right is left else CoverTree(x[right])
        counts, parent, edges = np.zeros(len(node), np.int64), list(range(len(node))), []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def join(i: int, j: int):
            u, v = root(i), root(j)
            if u != v:
                parent[u] = v
                edges.append((i, j))

        for i, j, whole in walk(a, b, threshold):
            i, j = left[i], right[j]
            if whole:
                counts[i] += n[j].sum()
                counts[j] += n[i].sum()
                for k in i:
                    join(k, j[0])
                for k in j[1:]:
                    join(i[0], k)
            else:
                np.add.at(counts, i, n[j])
                np.add.at(counts, j, n[i])
                for u, v in zip(i, j):
                    join(u, v)
        some = np.flatnonzero(counts)
        ends = [(int(node[i]), int(node[j])) for i, j in edges]
        cls = rows["cls"].take(pa.array(some, pa.int64())).combine_chunks()
        nothing = [None] * len(ends)
        return pa.table(
            {
                "cls": pa.chunked_array([cls if isinstance(cls, pa.Array) else pa.concat_arrays(cls.chunks), pa.array(nothing, pa.binary())], pa.binary()),
                "links": pa.array([*counts[some].tolist(), *nothing], pa.int64()),
                "a": pa.array([*[None] * len(some), *[e[0] for e in ends]], pa.int64()),
                "b": pa.array([*[None] * len(some), *[e[1] for e in ends]], pa.int64()),
            }
        )

    return run


def _deal(depth: int):
    """Members of one node (or a part of them) go to the nearest of the node's centres.

    The centres are the greedy net, at this level's radius, of the node's sample.
    """

    def run(members: pa.Table, centres: pa.Table) -> pa.Table:
        if not members.num_rows:
            return pa.table({"child": pa.array([], pa.string()), **{n: pa.array([], t) for n, t in (("cls", pa.binary()), ("node", pa.int64()), ("n", pa.int64()), ("unit", pa.binary()), ("far", pa.float64()))}})
        sample = [np.frombuffer(u, np.float64) for u in centres["units"][0].as_py()]
        net = [sample[0]]
        for u in sample[1:]:
            if all(np.sqrt(((u - c) ** 2).sum()) > 2.0 ** (1 - depth) for c in net):
                net.append(u)
        x = np.array([np.frombuffer(u, np.float64) for u in members["unit"].to_pylist()])
        far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ np.array(net).T)))
        best = far.argmin(axis=1)
        here = members["at"][0].as_py()
        gap = np.sqrt(((x - np.array(net)[best]) ** 2).sum(axis=1))
        return pa.table({"child": pa.array([f"{here}.{k}" for k in best], pa.string()), **{n: members[n] for n in ("cls", "node", "n", "unit")}, "far": pa.array(gap, pa.float64())})

    return run


def _near_pairs(threshold: float):
    """Keep the node pairs whose covering balls come within the threshold; ``whole`` marks balls that lie within it."""
    reach = _reach(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(u, np.float64) for u in batch.column(n).to_pylist()] for n in ("centre_a", "centre_b"))
            both = batch.column("radius_a").to_numpy() + batch.column("radius_b").to_numpy()
            apart = np.array([np.sqrt(((u - v) ** 2).sum()) for u, v in zip(a, b)])
            whole = pa.array(apart + both <= reach - 1e-6, pa.bool_())
            pairs = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), whole], ["a", "b", "whole"])
            yield pairs.filter(pa.array(apart <= both + reach + SLACK, pa.bool_()))

    return run


def _settle(members: DataFrame, whole: DataFrame) -> DataFrame:
    """Links and edges ``cls, links, a, b`` of node pairs in which every member links with every other.

    A member's links are the number of vectors in the nodes its node is paired with. One
    edge a member, to a vector of one of these nodes, and one edge a pair keep all of
    them connected, so a dense group of any size costs a row a member.
    """
    nodes = durable(members.groupBy("at").agg(F.sum("n").alias("vectors"), F.min("node").cast("long").alias("first"), F.count("*").alias("size")))
    facing = whole.select(F.col("a").alias("at"), F.col("b").alias("other")).union(whole.where("a <> b").select("b", "a"))
    others = nodes.select(F.col("at").alias("other"), F.col("vectors").alias("met"), F.col("first").alias("via"))
    met = durable(facing.join(others, "other").join(nodes.select("at", "first", "size"), "at"))
    per = met.groupBy("at", "size").agg(F.sum("met").alias("met"), F.min("via").alias("via"), F.bool_or(F.col("at") == F.col("other")).alias("own"))
    mine = attach(members.select("at", "cls", "node", "n"), durable(per), ["at"], "size", how="inner")
    links = F.col("met") - F.when(F.col("own"), F.col("n")).otherwise(F.lit(0))
    rows = mine.select("cls", links.cast("long").alias("links"), F.col("node").cast("long").alias("a"), F.col("via").alias("b"))
    return durable(rows.unionByName(met.where("at < other").select(F.lit(None).cast("binary").alias("cls"), F.lit(None).cast("long").alias("links"), F.col("first").alias("a"), F.col("via").alias("b"))))


def _grow(classes: DataFrame, threshold: float, leaf: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Leaves of the upper tree: members ``at, cls, node, n, unit``, near node pairs ``a, b``, and settled links.

    Level by level, a node of more than ``leaf`` members is split at the halved radius;
    its members are dealt out in parts of at most ``leaf``, however many there are. The
    pairs are walked along: children of a near pair are paired and kept if near. A pair
    whose balls lie within the threshold as a whole is settled by counting and leaves
    the walk; members that no open pair needs leave it too.
    """
    members = durable(classes.select(F.col("root").alias("at"), "cls", "node", "n", "unit"))
    done, settled = members.limit(0), []
    roots = members.select("at").distinct()
    pairs = durable(roots.select(F.col("at").alias("a"), F.col("at").alias("b")))
    for depth in range(1, DEPTH + 1):
        sizes = durable(members.groupBy("at").agg(F.count("*").alias("size")))
        wide = durable(sizes.where(F.col("size") > leaf))
        if wide.isEmpty():
            break
        small = sizes.where(F.col("size") <= leaf).select("at")
        done = done.unionByName(members.join(small, "at", "left_semi"))
        parts = wide.select("at", F.ceil(F.col("size") / leaf).alias("parts"), F.col("size"))
        mine = attach(members, durable(parts), ["at"], "size", how="inner")
        mine = mine.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")))
        order = Window.partitionBy("at").orderBy(F.xxhash64("cls", F.lit(depth)), "cls")
        # the literal bound lets every task hand on at most FAN members of a node
        picked = mine.select("at", "cls", "unit", "parts").withColumn("k", F.row_number().over(order)).where((F.col("k") <= FAN) & (F.col("k") <= 2 * F.col("parts")))
        sample = picked.groupBy("at").agg(F.max("parts").alias("parts"), F.transform(F.sort_array(F.collect_list(F.struct("k", "unit"))), lambda s: s["unit"]).alias("units"))
        sample = sample.select(F.col("at").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("of_part"), "units")
        dealt = mine.select("at", "part", "cls", "node", "n", "unit").groupBy("at", "part").cogroup(sample.groupBy("of", "of_part"))
        dealt = durable(dealt.applyInArrow(_deal(depth), "child string, cls binary, node long, n long, unit binary, far double"))
        # the centre of a child is any member; a ball around it is at most twice as wide as around the net's centre
        nodes = dealt.groupBy("child").agg(F.max("far").alias("far"), F.min_by("unit", "far").alias("centre"), F.min("far").alias("off"))
        nodes = nodes.select(F.regexp_replace("child", r"\.[0-9]+$", "").alias("parent"), F.col("child").alias("at"), "centre", (F.col("far") + F.col("off")).alias("radius"))
        ready = done.groupBy("at").agg(F.min_by("unit", "cls").alias("centre"))
        ready = ready.select(F.col("at").alias("parent"), "at", "centre", F.lit(2.0).alias("radius"))
        nodes = durable(nodes.unionByName(ready))
        left = nodes.select(F.col("parent").alias("a"), F.col("at").alias("child_a"), F.col("centre").alias("centre_a"), F.col("radius").alias("radius_a"))
        right = nodes.select(F.col("parent").alias("b"), F.col("at").alias("child_b"), F.col("centre").alias("centre_b"), F.col("radius").alias("radius_b"))
        opened = pairs.join(left, "a").join(right, "b").where("a <> b OR child_a <= child_b")
        opened = opened.select(F.col("child_a").alias("a"), F.col("child_b").alias("b"), "centre_a", "centre_b", "radius_a", "radius_b")
        near = durable(opened.mapInArrow(_near_pairs(threshold), "a string, b string, whole boolean"))
        pairs, whole = near.where("NOT whole").select("a", "b"), near.where("whole").select("a", "b")
        members = dealt.select(F.col("child").alias("at"), "cls", "node", "n", "unit")
        if not whole.isEmpty():
            settled.append(_settle(durable(done.unionByName(members)), whole))
            needed = durable(pairs.select(F.col("a").alias("at")).union(pairs.select("b")).distinct())
            members, done = durable(members.join(needed, "at", "left_semi")), durable(done.join(needed, "at", "left_semi"))
    return durable(done.unionByName(members)), pairs, settled


def _blocks(members: DataFrame, pairs: DataFrame, leaf: int) -> DataFrame:
    """Every member once per pair of blocks it takes part in: ``a, b, side`` and the member.

    A leaf that halving could not split further is cut into blocks by hash.
    """
    sizes = durable(members.groupBy("at").agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / leaf)))
    rows = attach(members, sizes, ["at"], "size", how="inner")
    rows = rows.withColumn("block", F.concat_ws("#", "at", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("string")))
    many = lambda c: F.transform(F.sequence(F.lit(0).cast("long"), F.col(c) - 1), lambda k: k.cast("string"))
    a = sizes.select(F.col("at").alias("a"), F.explode(many("blocks")).alias("i"))
    b = sizes.select(F.col("at").alias("b"), F.explode(many("blocks")).alias("j"))
    both = pairs.join(a, "a").join(b, "b").select(F.concat_ws("#", "a", "i").alias("x"), F.concat_ws("#", "b", "j").alias("y"), (F.col("a") == F.col("b")).alias("own"))
    both = durable(both.where("NOT own OR x <= y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    sides = both.select(F.col("a").alias("block"), "a", "b", F.lit(0).alias("side")).union(both.where("a <> b").select(F.col("b").alias("block"), "a", "b", F.lit(1).alias("side")))
    return rows.join(sides, "block").select("a", "b", "side", "cls", "node", "n", "unit")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of equal label link at a cosine of ``threshold`` or more, in double
    precision. Equal vectors are one class with a count. Upper levels of the cover tree
    are tables: nodes with centre and covering radius, and the node pairs still near,
    walked down together; pairs that link as a whole are settled by counting members. A
    pair of leaves is a task, which builds cover trees of its vectors and walks them in
    pairs. Links are counted where they are found; only edges that keep a group
    connected are listed.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows
    without label or vec_id, link with nothing: no links, and themselves as component.
    Vectors of different length never link. Rows of equal vec_id all appear and each
    counts as a vector; an empty table gives no rows.
    """
    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    kind = T.StructType([T.StructField("vec_id", vectors.schema[vec_id].dataType), T.StructField("root", T.StringType()), T.StructField("cls", T.BinaryType()), T.StructField("unit", T.BinaryType())])
    rows = durable(plain.mapInArrow(_prepare, kind))
    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.first("root").alias("root"), F.min("vec_id").cast("long").alias("node"), F.count("*").alias("n"), F.first("unit").alias("unit"))
    classes = durable(classes)
    members, pairs, settled = _grow(classes, threshold, leaf)
    tasks = _blocks(members, pairs, leaf).groupBy("a", "b")
    found = durable(tasks.applyInArrow(_compare(threshold), "cls binary, links long, a long, b long"))
    for part in settled:
        found = found.unionByName(part)
    links = found.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(found.where(F.col("a").isNotNull()).select("a", "b")).withColumnRenamed("node", "_node")
    facts = classes.select("cls", "node", "n").join(links, "cls", "left").join(groups, F.col("node") == F.col("_node"), "left")
    facts = durable(facts.select("cls", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    known = attach(rows.where(F.col("cls").isNotNull()).select("vec_id", "cls"), facts, ["cls"], "n").drop("cls")
    alone = rows.where(F.col("cls").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op2_embedding_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
