"""SimHash components against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cartloom.llm import simhash
from cartloom.llm.queries import QUERIES
from cartloom.llm.graph import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_triples_cover_four_bytes():
    triples = [set(t) for t in simhash.byte_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


@pytest.mark.parametrize("text", ["", " \n", "One", "one two THREE", "A b\x0bc\x0cd e É é\x85x", "w " * 40 + "x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_against_all_pairs(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    want = groups([d for d, _ in docs], [(a, b) for (a, x), (b, y) in combinations(docs, 2) if (x ^ y).bit_count() <= 4])
    got = QUERIES["op8_simhash"](spark, path).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{f:016x}", want[d]) for d, f in docs}


@pytest.mark.parametrize("block", [4, 64])
def test_links_in_long_lists(spark, block):
    rng = random.Random(block)
    near = {0xABCDEF0123456789 ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(150)}
    fps = sorted(near | {rng.getrandbits(64) for _ in range(40)})
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)]
    classes = spark.createDataFrame(rows, "fp long, node long")
    found = {r.node: r.component for r in components(simhash.links(classes, block=block)).collect()}
    want = groups(range(len(fps)), [(a, b) for a, b in combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {i: found.get(i, i) for i in range(len(fps))} == want


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_tally_in_a_list(max_bits):
    rng = random.Random(max_bits)
    base = [0x0102030405060708, 0x0102030405060708 ^ (0xFF << 40)]
    fps = sorted({rng.choice(base) ^ sum(1 << b for b in rng.sample(range(24, 64), rng.randint(0, 5))) for _ in range(300)})
    fp, node = np.array(fps, np.uint64), np.arange(len(fps))
    edges = list(simhash._forest(fp, node, (0, 1, 2), max_bits))
    assert all((fps[a] ^ fps[b]).bit_count() <= max_bits for a, b in edges)
    want = groups(range(len(fps)), [(a, b) for a, b in combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= max_bits])
    assert groups(range(len(fps)), edges) == want


def test_edges(spark):
    rows = [(5, None, 1), (3, "", 1), (9, " \t", 1), (None, "", 1), (7, "a b c d e f", 1), (7, "a b c d e f", 1), (8, "A B  c D\ne f", 1), (1, "quite another text here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").selectExpr("*", "1 AS node", "2 AS component_id")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (None, None), (7, 7), (7, 7), (8, 7), (1, 1)], key=repr)
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 200)]
    star = [(7, i) for i in range(300, 400)]
    pairs = [*path, *star, (250, 250), (None, 3), *path[:5]]
    random.Random(1).shuffle(pairs)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 201), 100), **dict.fromkeys([7, *range(300, 400)], 7)}
