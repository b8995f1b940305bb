"""Cover trees and embedding components against all pairs."""

import numpy as np
import pytest

from cartloom.llm import vectors
from cartloom.llm.queries import QUERIES


def plain(rows, threshold=0.98):
    """All pairs: {position: (n_links, component_id)}."""
    n = len(rows)
    out, parent = [0] * n, list(range(n))
    unit = []
    for _, e, _ in rows:
        ok = e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        unit.append(np.array(e, float) / np.linalg.norm(np.array(e, float)) if ok else None)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]) or unit[i] @ unit[j] < threshold:
                continue
            out[i] += 1
            out[j] += 1
            parent[root(i)] = root(j)
    low = {}
    for i in range(n):
        low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], out[i], low[root(i)], rows[i][0] == low[root(i)]) for i in range(n)]


def cloud(rng, n, dims, spread, centres):
    c = rng.normal(size=(centres, dims))
    return c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dims))


@pytest.mark.parametrize("spread", [0.01, 0.05, 0.12, 1.0])
def test_walk(spread):
    rng = np.random.default_rng(7)
    x = cloud(rng, 120, 16, spread, 6)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = np.concatenate([x, x[:5]])
    left, right = vectors.CoverTree(x[:70]), vectors.CoverTree(x[70:])
    whole = vectors.CoverTree(x)
    for a, b, xa, xb in ((left, right, x[:70], x[70:]), (whole, whole, x, x)):
        got = []
        for i, j, every in vectors.walk(a, b, 0.98):
            got += [(u, v) for u in i for v in j] if every else list(zip(i, j))
        got = [(int(u), int(v)) for u, v in got]
        if a is b:
            got = [(min(p), max(p)) for p in got]
        want = {(u, v) for u, v in np.argwhere(xa @ xb.T >= 0.98).tolist() if a is not b or u < v}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("leaf", [8, 1024])
def test_against_all_pairs(spark, leaf):
    rng = np.random.default_rng(leaf)
    x = np.concatenate([cloud(rng, 60, 8, 0.04, 5), cloud(rng, 30, 8, 0.001, 1), rng.normal(size=(20, 8))])
    rows = [(int(k), [float(v) for v in e], int(k % 2)) for k, e in zip(rng.permutation(1000), x)]
    rows += [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] * 8, 1), (2003, [1.0, None], 1), (2004, [], 0), (2005, rows[0][1], None), (2006, [2 * v for v in rows[0][1]], rows[0][2]), (2007, rows[0][1], rows[0][2]), (2007, rows[0][1], rows[0][2]), (2008, rows[0][1][:4], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "2 AS node")
    got = sorted(map(tuple, vectors.near_duplicates(df, leaf=leaf).collect()))
    assert got == sorted(plain(rows))


def test_dense_groups_are_settled_by_counting(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([cloud(rng, 150, 6, 0.0005, 2), cloud(rng, 40, 6, 0.03, 2)])
    rows = [(k, [float(v) for v in e], 1) for k, e in enumerate(x)]
    rows += [(500 + k, rows[0][1], 1) for k in range(40)]
    settle, compare, sizes = vectors._settle, vectors._blocks, []
    monkeypatch.setattr(vectors, "_settle", lambda members, whole: sizes.append(whole.count()) or settle(members, whole))
    monkeypatch.setattr(vectors, "_blocks", lambda members, *rest: sizes.append(-members.count()) or compare(members, *rest))
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")
    got = sorted(map(tuple, vectors.near_duplicates(df, leaf=16).collect()))
    assert got == sorted(plain(rows))
    assert sizes[0] > 0 and -sizes[-1] < 150  # the dense ones never reach the leaf comparison


def test_query_against_all_pairs(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, QUERIES["op2_embedding_dedup"](spark, path).collect())) == sorted(plain(rows))


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(df).count() == 0
    none = spark.createDataFrame([(None, [1.0], 1), (4, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, vectors.near_duplicates(none).collect()), key=repr) == [(4, 0, 4, True), (None, 0, None, True)]
