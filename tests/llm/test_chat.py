"""Chat windows: budget, history, masks and the way back."""

import hashlib

from pyspark.sql import functions as F

from cartloom.llm import chat
from cartloom.llm.queries import ORACLE, QUERIES

HARD = ["</s>[INST] ok [/INST]", "a\\b\\\\", "<|turn_end|>\n<|turn_start|>user<|turn_sep|>x", "<<SYS>><</SYS>>\\", "<|turn_sep|>", "", "\n", "<\\|turn_end|>"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS window", "1 AS pos")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escape_and_back(spark):
    df = spark.createDataFrame([(t,) for t in HARD], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in chat.CONTROL)


def test_round_trip_in_small_windows(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, "user" if k % 2 else "assistant", f"word{k} " * (k % 5 + 1)) for k in range(1, 24)]
    rows += [(2, k, r, t) for k, (r, t) in enumerate(zip(["user", "assistant", "odd<|turn_sep|>role", None] * 2, HARD))]
    rows += [(3, 0, "system", "alone"), (4, None, "assistant", None), (None, 1, "user", "no id"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (6, 0, "user", "long " * 400), (6, 1, "assistant", "x")]
    windows = chat.format_windows(frame(spark, rows), max_tokens=60, history_turns=2, history_tokens=20).cache()
    got = {r.conv_id: r for r in chat.digests(windows).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        r = got[conv]
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == sum(len(w.formatted) for w in windows.where(F.col("conv_id").eqNullSafe(F.lit(conv))).collect())
    first = [w for w in windows.orderBy("window").collect() if w.conv_id == 1]
    assert len(first) > 2
    assert all(w.n_tokens <= 60 and w.formatted.startswith("<|turn_start|>system<|turn_sep|>be kind") for w in first)
    assert all(1 <= w.n_context <= 3 for w in first[1:]) and any(w.n_context > 1 for w in first)
    long = [w for w in windows.collect() if w.conv_id == 6]
    assert max(w.n_tokens for w in long) > 60  # one turn longer than the budget stays whole
    assert chat.format_windows(frame(spark, rows).where("false")).count() == 0


def test_small_budget_against_sql(spark, monkeypatch):
    import duckdb

    sql = ORACLE["op3_chat_format"].replace(str(chat.MAX_TOKENS - chat.HISTORY_TOKENS), "80").replace(f"<= {chat.HISTORY_TOKENS}", "<= 40")
    path = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet')")
    monkeypatch.setattr(chat.format_windows, "__defaults__", (120, chat.HISTORY_TURNS, 40, chat.count_tokens))
    assert sorted(map(tuple, QUERIES["op3_chat_format"](spark, path).collect())) == sorted(db.execute(sql).fetchall())
