"""Decontamination against plain windows."""

import random
import re

from cartloom.llm import benchmarks

WORD = re.compile(benchmarks.WORDS)


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    found = {}
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for i, t in items:
            v = words(t)
            n = min(10, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    ids.add(str(i))
        if hit:
            found[d, text] = (len(hit), sorted(ids))
    return found


def test_planted_spans(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "Straße", "x1"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.randint(10, 40))) for k in range(12)] + [(20, "alpha beta gamma"), (21, "Omega"), (22, None), (23, " .. "), (24, say(10)), (3, "alpha beta gamma"), (25, "la la la la la la la la la la la")]
    docs = []
    for k in range(40):
        item = words(rng.choice(items)[1])
        at, size = rng.randint(0, max(0, len(item) - 9)), rng.choice([8, 9, 10, 11, 25])
        docs.append((k, f"{say(rng.randint(0, 15))}, {'-'.join(item[at : at + size]).upper()}; {say(rng.randint(0, 15))}"))
    docs += [(50, None), (51, ""), (52, "ALPHA beta, gamma"), (53, "omega"), (53, "none of it"), (54, "la " * 50), (None, "alpha beta gamma"), (52, "ALPHA beta, gamma"), (55, say(8000) + " " + items[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS mark", "'w' AS words")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS words")
    got = {}
    for r in benchmarks.contamination(df, bench).collect():
        got.setdefault((r.doc_id), []).append((r.n_hit, r["items"]))
    want = {}
    for (d, _), v in plain(docs, items).items():
        want.setdefault(d, []).append(v)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    clean = benchmarks.decontaminate(df, bench)
    assert clean.columns == df.columns
    bad = plain(docs, items)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted((d for d in docs if d not in bad), key=repr)
    assert benchmarks.contamination(df, bench.where("false")).count() == 0
    assert benchmarks.contamination(df.where("false"), bench).count() == 0


def test_repeated_words_at_any_offset(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(f"r{rng.randint(0, 500)}" for _ in range(n))
    spans = ["0 " * 10, "0 1 " * 5, "0 1 " * 9, "ha ha ho " * 4, "1 2 3 4 5 " * 2, "0 0 0 0 0 0 0 0 0 1"]
    items = [(k, f"{say(k)} {span} {say(3 * k)}") for k, span in enumerate(spans)] + [(9, "0 " * 10)]
    docs = [(k, f"{say(rng.randint(0, 20))} {rng.choice(spans)} {say(rng.randint(0, 20))}") for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in benchmarks.contamination(df, bench).collect()}
    assert got == {d: v for (d, _), v in plain(docs, items).items()}
    assert len(got) == len(docs)
