"""Quality classifier: ratios against plain counts, the machine against its dual, held-out accuracy, odd rows."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cartloom.llm import quality
from cartloom.llm.queries import QUERIES

PATH = "/root/testdata/sf0.01"


def plain_features(text):
    """The same buckets, character by character."""
    text = text or ""
    chars = [ord(c) for c in text]
    words = [w for w in __import__("re").split(r"[ \t-\r]+", text) if w]
    one = lambda *parts, kind: int(quality._bucket(*[np.array([p], np.uint32) for p in parts], kind=kind)[0])
    out = {one(0, kind=0)}
    for n in (1, 2, 3):
        out |= {one(*chars[i : i + n], kind=n) for i in range(len(chars) - n + 1)}
    names = []
    for w in words:
        total = 0
        for k, c in enumerate(w):
            m = (ord(c) + 0x5BD1) * (2 * k + 1) * 2654435761 % 2**32
            total = (total + (m ^ (m >> 13))) % 2**32
        names.append(total)
    shapes = []
    for i, w in enumerate(words):
        kinds = [16 if ord(c) >= 128 else 1 if "A" <= c <= "Z" else 2 if "a" <= c <= "z" else 4 if "0" <= c <= "9" else 8 for c in w]
        shape = 0
        for k in kinds:
            shape |= k
        shape |= (kinds[0] & 1) << 5
        shape |= (i > 0 and words[i - 1] == w) << 6
        shape |= (i > 1 and words[i - 2] == w) << 7
        shapes.append(int(shape))
    for seq, kind in ((names, 4), (shapes, 6)):
        for n in (1, 2, 3) if kind == 6 else (1, 2):
            out |= {one(*seq[i : i + n], kind=kind + n - 1) for i in range(len(seq) - n + 1)}
    return sorted(out)


def test_features_of_whole_texts():
    long = "start " + "some words in a row, " * 30000 + "Unlike123 THE end"
    assert set(quality.features(long)) >= set(quality.features("Unlike123 THE end")) - set(quality.features("x Unlike123"))
    for text in (None, "", " \n", "a", "Ab a1! Ab Ab ", "Éa é \t THE the the 9", "x" * 70):
        assert quality.features(text).tolist() == plain_features(text), text


def test_pieces_join(monkeypatch):
    text = "The quick brown fox, and 12 more. " * 20
    whole = quality.features(text).tolist()
    monkeypatch.setattr(quality, "PIECE", 7)
    assert quality.features(text).tolist() == whole


def test_machine_reaches_the_optimum():
    """Primal and dual value meet, which proves both optimal; no random point is better."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 6))
    y = np.where(x[:, 0] + 0.7 * rng.normal(size=40) > 0, 1.0, -1.0)
    cost = np.where(y > 0, 0.5, 0.8)
    rows = [(np.arange(6), r) for r in x]
    w = quality.fit_hinge(rows, y, 6, cost, passes=5000, tolerance=1e-8)
    primal = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    # the dual by plain projected gradient
    q = (y[:, None] * x) @ (y[:, None] * x).T
    a = np.zeros(40)
    for _ in range(60000):
        a = np.clip(a - (q @ a - 1) / np.linalg.eigvalsh(q).max() if _ == 0 else a - (q @ a - 1) * step, 0, cost)
        if _ == 0:
            step = 1 / np.linalg.eigvalsh(q).max()
    assert abs(primal(w) - (a.sum() - a @ q @ a / 2)) < 1e-5
    assert all(primal(w + 0.1 * rng.normal(size=6)) >= primal(w) for _ in range(200))


def test_counts_cover_all_labelled_texts(spark):
    """The ratios do not depend on the sample of the machine, and equal a plain count."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    small, large = quality.learn(docs, labels, sample=20), quality.learn(docs, labels, sample=2000)
    assert np.allclose(small.ratios, large.ratios)
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    counts = np.zeros((2, 1 << quality.BITS))
    for r in labels.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 5:
            counts[r.quality, plain_features(text[r.doc_id][:0]) if not text[r.doc_id] else quality.features(text[r.doc_id])] += 1
    assert np.allclose(large.ratios, quality.log_ratios(counts[1], counts[0]))


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    n = spark.read.parquet(f"{PATH}/documents.parquet").count()
    rows = QUERIES["op12_quality"](spark, PATH).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    good, bad = ([r.score for r in held if truth[r.doc_id] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.99


def test_labels_of_held_out_texts_do_not_matter(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.judge(docs.select("doc_id", "text"), quality.learn(docs, x)).collect())) for x in (labels, turned))
    assert a == b


def test_edges(spark):
    clean = [(i, f"The fox number {i} sits in the old wood and sleeps.", "keep", 9) for i in range(1, 40)]
    junk = [(i, f"%%% BUY!! NOW!! {i} $$$ &&&", None, 9) for i in range(40, 80)]
    odd = [(None, "The fox", None, 9), (81, None, None, 9), (82, "", None, 9), (83, "long words " * 40000, None, 9), (1, clean[0][1], None, 9)]
    docs = spark.createDataFrame(clean + junk + odd, "doc_id long, text string, score string, _id int")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(1, 80)] + [(5, 1), (None, 1), (6, None), (900, 0), (7, 3)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    out = quality.judge(docs, model)
    assert out.columns == ["doc_id", "text", "_id", "score", "predicted"]
    got = out.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in clean + junk + odd)
    assert all(r.predicted == (r.doc_id < 40) for r in got if r.doc_id and r.doc_id < 80)
    assert len({r.score for r in got if r.doc_id in (81, 82)}) == 1
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert quality.judge(docs.where("false"), model).count() == 0
    none = quality.judge(docs, quality.learn(docs, labels.where("false")))
    assert {r.score for r in none.collect()} == {0.5}
    one = quality.judge(docs, quality.learn(docs, labels.where("quality = 1")))
    assert all(r.score > 0.9 for r in one.collect())
