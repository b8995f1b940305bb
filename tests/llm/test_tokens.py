"""Prefix tables against the library, one prefix at a time."""

import numpy as np
import pytest

from cartloom.llm import tokens

TEXTS = [
    "", " ", "The quick, brown fox!", "don't we'll 'r 're x're", "a\x0bb\x0cc\td\r\ne", "<|endoftext|> x<|endoftext|>y <|endof",
    "!!!<|startoftext|>!!", "Ä ß é é İstanbul ẞ", "x y z\x1cw", "123 4567 12a3", "🙂🙃 漢字かな", "WORD, Ünï-ßcode×÷ x<y a&&b ªº 1st2nd #%@",
]
LONG = [
    "a" * 90, "the" * 40, "abcdefghijklmnopqrstuvwxyz" * 4 + "!!" * 30 + "'re" * 12, "=" * 70 + "-" * 50, "漢字" * 40,
    "antidisestablishment" * 5 + "<|endoftext|>" + "tail" * 20, "é" * 50 + "é" * 10, "İx" * 30, "hasthentionreedouon" * 6,
]


@pytest.fixture(scope="module")
def count():
    return tokens.PrefixCounter(tokens.default_tokenizer())


@pytest.mark.parametrize("text", TEXTS + LONG + ["lead " + x + " tail" for x in LONG[:4]])
def test_every_prefix(count, text):
    want = [0] + count.ask([text[:i] for i in range(1, len(text) + 1)])
    assert np.frombuffer(count.prefixes([text])[0], ">u4").tolist() == want


def test_memory_is_bounded(count, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    for k in range(4):
        count.prefixes([f"w{k} x{k} y{k} z{k}"])
    assert len(count.tables) <= 8


def test_table(spark):
    rows = [(1, "The quick <|endoftext|>"), (1, None), (None, ""), (4, "w " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS prefix", "1 AS n_chars")
    got = tokens.prefix_table(docs)
    from pyspark.sql import functions as F

    out = got.select("doc_id", "n_bytes", tokens.tokens_at(F.col("prefix"), F.col("n_chars")).alias("n"), tokens.longest_within(F.col("prefix"), 2).alias("fit")).collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(1, 23, 3, 10), (1, 0, 0, 0), (None, 0, 0, 0), (4, 6000, 3000, 4)], key=repr)
    assert tokens.prefix_table(docs.where("false")).count() == 0


def test_query_counts_as_the_library(spark, count):
    from cartloom.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    whole = dict(zip(texts, count.ask(list(texts.values()))))
    got = QUERIES["op10_token_counts"](spark, path).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {(k, len(t.encode()), whole[k], whole[k] > 2048) for k, t in texts.items()}
