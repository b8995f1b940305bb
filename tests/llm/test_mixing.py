"""Mixing: budgets of small trees, epochs and odd rows."""

from pyspark.sql import functions as F

from cartloom.llm import mixing


def leaves(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")


def test_shortage_goes_to_siblings_first(spark):
    tree = leaves(spark, [("a", "x", "1", 10), ("a", "x", "2", 500), ("a", "y", "1", 500), ("b", "x", "1", 500), ("b", "x", "2", 500)])
    out = {(r.domain, r.lang, r.source): r.budget for r in mixing.allocate(tree, mixing.LEVELS, {}, 400, 1).collect()}
    assert out == {("a", "x", "1"): 10, ("a", "x", "2"): 90, ("a", "y", "1"): 100, ("b", "x", "1"): 100, ("b", "x", "2"): 100}
    weights = {"domain": {"b": 3}, "source": {"2": 2}}
    out = {(r.domain, r.lang, r.source): r.budget for r in mixing.allocate(tree, mixing.LEVELS, weights, 1800, 1).collect()}
    assert out[("b", "x", "1")] == out[("b", "x", "2")] == 500 and out[("a", "x", "1")] == 10 and sum(out.values()) == 1800  # b is short: a takes the rest
    assert sum(r.budget for r in mixing.allocate(tree, mixing.LEVELS, {}, 9999, 2).collect()) == 2 * 2010


def test_prefix_and_epochs(spark):
    rows = [(k, "word " * (k % 4 + 1), "en", "src1") for k in range(40)] + [(100 + k, "a b", "de", "src1") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "5 AS n_epochs", "'m' AS mark")
    full = {r.doc_id: r for r in mixing.selection(docs, share=1.0, weights={"lang": {"de": 1, "en": 1}}, epochs=3).collect()}
    assert all(full[100 + k].n_epochs == 3 for k in range(3))  # small leaf: all its epochs
    part = mixing.selection(docs, share=0.5, weights={}, epochs=1).collect()
    assert sum(r.tokens * r.n_epochs for r in part) <= 53
    assert sum(r.tokens * r.n_epochs for r in part) > 53 - 5
    assert sorted(map(tuple, part)) == sorted(map(tuple, mixing.selection(docs.repartition(7), share=0.5, weights={}, epochs=1).collect()))
    out = mixing.mix(docs, share=0.5, weights={}, epochs=1)
    assert out.columns == ["doc_id", "text", "lang", "source", "mark", "n_epochs"]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in part}


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "en", "x"), (None, "a b c", "en", "src9"), (3, "t " * 50_000, "en", "src9"), (3, "other", "en", "src9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(docs, share=1.0, epochs=1)
    assert out.count() == 5 and out.select(F.max("n_epochs")).first()[0] == 1
    assert mixing.mix(docs.where("false")).count() == 0
