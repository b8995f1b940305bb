"""Streams over small arriving files."""

import datetime

import pytest
from helpers import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.buckets import BucketTable
from cartloom.operators.groups import Order
from cartloom.operators.metering import tumbling
from cartloom.streaming import alerts, cdc, ingest

DDL = "id int, v string"


def put(spark, path, rows, ddl=DDL):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def test_each_file_once(spark, tmp_path):
    inbox, table, mark = (f"{tmp_path}/{x}" for x in "abc")
    for rows in ([(1, "a")], [(2, "b"), (3, "c")], []):
        if rows:
            put(spark, inbox, rows)
        stream = ingest.arriving(spark, inbox, DDL, pattern="*.parquet")
        ingest.append_to(ingest.with_source_file(stream), table, mark)
    assert rows_of(spark.read.parquet(table), "id") == [(1,), (2,), (3,)]
    put(spark, inbox, [(4, "d")])
    lag = {r["state"]: (r["files"], r["rows"]) for r in ingest.lag(spark, inbox, spark.read.parquet(table), "*.parquet").collect()}
    assert lag == {"loaded": (2, 3), "pending": (1, 0)}


FEED = "id int, v string, action string, is_update boolean, round int"


def test_merge_stream_is_idempotent_and_skips_nothing_new(spark, tmp_path):
    table, feed, mark = (f"{tmp_path}/{x}" for x in "abc")
    spark.createDataFrame([(1, "a"), (2, "b")], DDL).write.parquet(f"{table}/version=0")

    def run():
        cdc.merge_stream(spark, ingest.arriving(spark, feed, FEED), table, mark, ["id"], [Order("round")])
        return rows_of(cdc.latest_state(spark, table), "id", "v")

    put(spark, feed, [(1, "a", "DELETE", True, 1), (1, "x", "INSERT", True, 1), (3, "c", "INSERT", False, 1)], FEED)
    assert run() == [(1, "x"), (2, "b"), (3, "c")]
    assert run() == [(1, "x"), (2, "b"), (3, "c")]  # no new file: no new version
    assert ingest.versions(spark, table) == [0, 1]
    put(spark, feed, [(1, "x", "INSERT", True, 1), (2, "b", "DELETE", False, 2)], FEED)
    assert run() == [(1, "x"), (3, "c")]


def part_times(path):
    return {str(p): p.stat().st_mtime_ns for p in path.glob("parts/*/*/*.parquet")}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path, feed, mark = tmp_path / "table", f"{tmp_path}/feed", f"{tmp_path}/mark"
    rows = [(k, f"v{k}") for k in range(2000)]
    table = BucketTable(spark, str(path), T.StructType.fromDDL(DDL), ("id",), buckets=64)
    table.create(spark.createDataFrame(rows, DDL))
    before = part_times(path)
    assert len(before) == 64

    def run():
        cdc.merge_buckets(ingest.arriving(spark, feed, FEED), table, mark, [Order("round")])
        return dict(rows_of(table.read(), "id", "v"))

    want = dict(rows)
    changed = list(range(0, 2000, 100))  # one key of a hundred
    put(spark, feed, [(k, "new", "INSERT", True, 1) for k in changed], FEED)
    want |= {k: "new" for k in changed}
    assert run() == want
    after = part_times(path)
    fresh_parts = {p.split("_bucket=")[1].split("/")[0] for p in after if "version=1/" in p}
    hit = {str(r[0]) for r in spark.createDataFrame([(k,) for k in changed], "id int").select(table.bucket()).distinct().collect()}
    assert fresh_parts == hit and len(hit) < 22
    assert all(after[p] == t for p, t in before.items())  # no other file was written; the version before stays
    assert run() == want and part_times(path) == after  # no new files: nothing is written
    # the same changes in a later batch change no row
    put(spark, feed, [(k, "new", "INSERT", True, 1) for k in changed], FEED)
    assert run() == want
    kept = {p for p in part_times(path) if "version=0/" in p}
    assert all(p.split("_bucket=")[1].split("/")[0] not in hit for p in kept)  # pruned where replaced
    assert table.versions() == [1, 2]


def test_a_repeated_fold_and_emptied_buckets(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/t", T.StructType.fromDDL(DDL), ("id",), buckets=3)
    table.create(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], DDL))
    feed = spark.createDataFrame([(1, "x", "INSERT", True, 1), (2, "b", "DELETE", False, 1), (9, "i", "INSERT", False, 1)], FEED)
    for _ in range(2):  # the second one as after a failure
        table.fold(feed, 0, [Order("round")])
        assert rows_of(table.read(), "id", "v") == rows_of(spark.createDataFrame([(1, "x"), (9, "i"), (None, "n")], DDL), "id", "v")
    assert rows_of(table.read(0), "v") == [("a",), ("b",), ("n",)]
    # a version whose list was never finished is not seen
    table._write(spark.createDataFrame([(7, "half")], DDL), 2)
    assert rows_of(table.read(), "v") == [("i",), ("n",), ("x",)]
    gone = spark.createDataFrame([(1, "x", "DELETE", False, 2), (9, "i", "DELETE", False, 2), (None, "n", "DELETE", False, 2)], FEED)
    table.fold(gone, 1, [Order("round")])
    assert rows_of(table.read(), "v") == [("n",)]  # a NULL key is matched by no change
    assert len(table.parts()) == 1  # emptied buckets drop out
    empty = BucketTable(spark, f"{tmp_path}/e", T.StructType.fromDDL(DDL), ("id",))
    empty.create(spark.createDataFrame([], DDL))
    assert empty.read().count() == 0
    assert empty.fold(feed.where("false"), 0, [Order("round")]) == [] and empty.versions() == [0, 1]


def test_a_failed_batch_is_repeated(spark, tmp_path):
    inbox, out, mark = (f"{tmp_path}/{x}" for x in "abc")
    put(spark, inbox, [(1, "a")])

    def broken(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/version={number}")
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest.each_batch(ingest.arriving(spark, inbox, DDL), mark, broken)
    ingest.snapshots(ingest.arriving(spark, inbox, DDL).groupBy("v").count(), f"{out}2", f"{mark}2")
    ingest.each_batch(
        ingest.arriving(spark, inbox, DDL), mark, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/version={n}")
    )
    assert rows_of(ingest.current(spark, out), "id", "v") == [(1, "a")]
    assert rows_of(ingest.current(spark, f"{out}2"), "v", "count") == [("a", 1)]


T0 = datetime.datetime(2024, 1, 1, 12, 0)
AT = "at timestamp_ntz, id int"


def minute(m):
    return T0 + datetime.timedelta(minutes=m)


def test_late_rows_are_let_go(spark, tmp_path):
    inbox, fired, mark = (f"{tmp_path}/{x}" for x in "abc")

    def run(rows):
        put(spark, inbox, rows, AT)
        stream = alerts.stamped(ingest.arriving(spark, inbox, AT), "at", "10 minutes")
        ingest.append_to(alerts.slices(stream, "at", "2 minutes"), fired, mark)
        return rows_of(spark.read.parquet(fired), "slice_start", "rejected")

    assert run([(minute(0), 1), (minute(1), 2), (minute(3), 3)]) == []  # nothing closed yet
    assert run([(minute(1), 4), (minute(20), 5)]) == [(minute(0), 3), (minute(2), 1)]
    # Minute 1 is closed by now: its late row changes nothing.
    assert run([(minute(1), 6), (minute(40), 7)]) == [(minute(0), 3), (minute(2), 1), (minute(20), 1)]


def test_slices_agree_on_table_and_stream(spark, tmp_path):
    inbox, fired, mark = (f"{tmp_path}/{x}" for x in "abc")
    rows = [(minute(i * 7 % 60), i) for i in range(100)] + [(minute(600), 100)]
    put(spark, inbox, rows, AT)
    stream = alerts.stamped(ingest.arriving(spark, inbox, AT), "at", "5 minutes")
    ingest.append_to(alerts.slices(stream, "at", "6 minutes"), fired, mark)
    table = tumbling(spark.read.parquet(inbox), "at", "6 minutes", [], F.count(F.lit(1)).alias("rejected"))
    closed = table.filter(F.col("slice_start") < F.lit(minute(500)))
    assert rows_of(spark.read.parquet(fired)) == rows_of(closed) != []


def test_split_stream(spark, tmp_path):
    inbox, good, bad, mark = (f"{tmp_path}/{x}" for x in "abcd")
    rules = [(F.col("v").isNull(), "no value")]
    for rows in ([(1, "a"), (2, None)], [(3, None)]):
        put(spark, inbox, rows)
        cdc.split_stream(ingest.arriving(spark, inbox, DDL), rules, good, bad, mark)
    assert rows_of(spark.read.parquet(good), "id") == [(1,)]
    assert rows_of(spark.read.parquet(bad), "id", "reason") == [(2, "no value"), (3, "no value")]


def looped(rows, gap, lateness):
    """Alerts over all rows by a plain loop, closed slices only."""
    start = datetime.datetime(2024, 1, 1)
    mark = max(at for _, at in rows) - lateness
    events = []
    for key in {k for k, _ in rows}:
        spell = None
        for at in sorted(at for k, at in rows if k == key):
            if start + ((at - start) // gap + 1) * gap > mark:
                break
            if spell and at - spell[1] > gap:
                events.append((key, "cleared", spell[1] + gap, spell[2]))
                spell = None
            if spell is None:
                events.append((key, "fired", at, None))
            spell = (spell[0], at, spell[2] + 1) if spell else (at, at, 1)
        if spell and spell[1] + 2 * gap < mark:
            events.append((key, "cleared", spell[1] + gap, spell[2]))
    return sorted(events, key=repr)


def test_alerts_fire_once_a_spell(spark, tmp_path):
    """Rows out of order and repeated within the lateness, long quiet spells, a NULL key, runs without rows."""
    import random

    r = random.Random(5)
    start, minute = datetime.datetime(2024, 1, 1), datetime.timedelta(minutes=1)
    inbox, out, mark = (f"{tmp_path}/{x}" for x in "abc")
    rows, offset = [], 0.0
    for run in range(4):
        new = []
        for _ in range(40):
            offset += r.choice([0, 0.2, 0.5, 1, 2, 2.05, 3, 45])
            late = r.choice([0, 0, 0, 3, 8]) if run else 0
            at = start + datetime.timedelta(seconds=round((offset - min(late, offset)) * 60, 1))
            new += [(r.choice(["a", "b", None]), at)] * r.choice([1, 1, 2])
        if run == 2:
            offset += 600
        seen = max((at for _, at in rows), default=start)
        new = [(k, at) for k, at in new if not rows or at > seen - 9 * minute]  # within the lateness of 10 minutes
        put(spark, inbox, new, "key string, at timestamp_ntz")
        rows += new
        for _ in range(2):  # the second run finds no new file
            stream = alerts.stamped(ingest.arriving(spark, inbox, "key string, at timestamp_ntz"), "at", "10 minutes")
            with alerts.state_store(spark):
                ingest.append_to(alerts.spells(stream, "at", 120, ["key"]), out, mark)
        got = [(e["key"], e["state"], e["at"], e["rejected"]) for e in spark.read.parquet(out).withColumn("at", F.col("at").cast("timestamp_ntz")).collect()]
        assert sorted(got, key=repr) == looped(rows, 2 * minute, 10 * minute)
    assert alerts.STORE not in str(spark.conf.get(alerts.STORE, "")) and len(got) > 20
