"""Language id: accuracy on held-out documents, and texts without letters."""

import zlib

import numpy as np

from cartloom.llm import language
from cartloom.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language_id"](spark, path).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_label_and_held_out_text_do_not_matter(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, language.identify(docs.select("doc_id", "text"), language.learn(d)).collect())) for d in (docs, changed))
    assert a == b


def test_edges(spark):
    rows = [(1, "der die das und", "de", "x"), (2, "the and of", "en", "x"), (3, None, "en", None), (4, "", "en", None), (5, "12 !?", None, "x"), (None, "the of", "en", "x"), (2, "the and of", "en", "x"), (7, "le la les des", "fr", "x"), (8, "tlh " * 5000, "tlh", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.learn(docs)
    out = language.identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.text in (None, "", "12 !?"))
    assert {r.lang_pred for r in got if r.text == "the and of"} == {"en"}
    assert language.identify(docs.where("false"), model).count() == 0
    nothing = language.learn(docs.where("false"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    alone = language.learn(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in language.identify(docs, alone).collect()} == {"en", "und"}


def test_machine_against_the_dual_by_small_steps():
    rng = np.random.default_rng(5)
    y = np.repeat([1.0, -1.0], [25, 15])
    x = rng.normal(size=(40, 4)) + 0.8 * y[:, None]
    w = language.fit_svm(x, y)
    z = np.column_stack([x, np.ones(40)]) * y[:, None]
    cost = np.array([language.COST * 40 / (2 * (y == s).sum()) for s in y])
    alpha, step = np.zeros(40), 1.0 / np.linalg.eigvalsh(z @ z.T).max()
    for _ in range(50_000):  # projected gradient on the same dual
        alpha = np.clip(alpha + step * (1.0 - z @ (z.T @ alpha)), 0.0, cost)

    def primal(v):
        return v @ v / 2 + (cost * np.maximum(0.0, 1.0 - z @ v)).sum()

    exact = alpha.sum() - (z.T @ alpha) @ (z.T @ alpha) / 2
    assert exact - 1e-6 <= primal(w) <= 1.02 * primal(z.T @ alpha)


def test_prediction_against_two_plain_steps():
    texts = {"en": "the and of to in", "de": "der die und das nicht", "fr": "le la les des et", "es": "el los las una y"}
    model = language.LanguageModel(np.array([language.features(t) for t in texts.values()]), list(texts))

    def winner(machines, x):
        def worst(name):
            held = [(w if a == name else -w) for (a, b), w in machines.duels.items() if name in (a, b)]
            return min([1.0, *(1.0 / (1.0 + np.exp(-language.SLOPE * (w @ np.append(x, 1.0)))) for w in held)])

        return max(((worst(name), name) for name in machines.classes), key=lambda found: found[0])

    for text in [*texts.values(), "une maison", "the house", "das Haus und", "zz"]:
        x = language.features(text)
        sure, family = winner(model.families, x)
        surer, lang = winner(model.within[family], x)
        name, score = model.predict(text)
        assert name == lang and abs(score - sure * surer) < 1e-9
