"""Load ledger and totals that are refreshed from new files alone."""

import os

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from cartloom.operators.maintained import MaintainedTotals
from cartloom.sources.ledger import Ledger, load_folder, loaded_rows
from cartloom.sources.loading import LoadError, OnError

DDL = "id bigint, price double"


def put(folder, name, lines, at=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,price\n" + "".join(f"{x}\n" for x in lines))
    if at:
        os.utime(folder / name, (at, at))


@pytest.fixture
def books(spark, tmp_path):
    return Ledger(spark, f"{tmp_path}/ledger")


def test_files_are_known_by_length_and_time_too(spark, tmp_path, books):
    inbox, table = tmp_path / "in box", f"{tmp_path}/table"
    put(inbox, "a.csv", ["1,1.5", "2,2.5"], at=1_700_000_000)
    put(inbox, "b+1.csv", ["3,3.5"])
    load = lambda **more: load_folder(books, str(inbox), table, DDL, pattern="*.csv", **more)
    ids = lambda: [r[0] for r in rows_of(loaded_rows(books, table), "id")]
    assert load() == 2 and ids() == [1, 2, 3]
    assert load() == 0 and books.loads() == [0]
    put(inbox, "c.csv", ["4,4.5"])
    assert load() == 1 and ids() == [1, 2, 3, 4]
    put(inbox, "a.csv", ["5,5.5", "6,6.5"], at=1_700_000_100)  # same name and length, another time
    assert load() == 1 and ids() == [1, 2, 3, 4, 5, 6]
    put(inbox, "a.csv", ["7,7.5"], at=1_700_000_100)  # same name and time, another length
    assert load() == 1 and ids() == [1, 2, 3, 4, 5, 6, 7]
    assert load() == 0
    assert load(force=True) == 3 and ids() == [1, 2, 3, 3, 4, 4, 5, 6, 7, 7]
    assert load() == 0


def test_skipped_and_failed_files_are_offered_again(spark, tmp_path, books):
    inbox, table = tmp_path / "in", f"{tmp_path}/table"
    put(inbox, "good.csv", ["1,1.5"])
    put(inbox, "bad.csv", ["2,x"])
    put(inbox, "none.csv", [])
    with pytest.raises(LoadError):
        load_folder(books, str(inbox), table, DDL, OnError.ABORT)
    assert books.loads() == []
    assert load_folder(books, str(inbox), table, DDL, OnError.SKIP_FILE) == 3
    assert rows_of(loaded_rows(books, table), "id") == [(1,)]
    status = {r.file.split("/")[-1]: r.status for r in books.entries().collect()}
    assert status == {"good.csv": "LOADED", "bad.csv": "LOAD_SKIPPED", "none.csv": "LOADED"}
    assert [r.file.split("/")[-1] for r in books.pending(str(inbox)).collect()] == ["bad.csv"]
    put(inbox, "bad.csv", ["2,2.5"])
    assert load_folder(books, str(inbox), table, DDL, OnError.SKIP_FILE) == 1
    assert rows_of(loaded_rows(books, table), "id") == [(1,), (2,)]


def test_a_load_without_entries_does_not_count(spark, tmp_path, books):
    inbox, table = tmp_path / "in", f"{tmp_path}/table"
    put(inbox, "a.csv", ["1,1.5"])

    def broken(rows):
        rows.write.parquet(f"{table}/load=0")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        load_folder(books, str(inbox), table, DDL, finish=broken)
    assert load_folder(books, str(inbox), table, DDL) == 1
    assert rows_of(loaded_rows(books, table), "id") == [(1,)]


def items(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, "product_id long, amount double").coalesce(1).write.mode(mode).parquet(path)


def parts(path):
    return sorted(p for p in path.glob("*.parquet"))


def test_totals_follow_new_files_only(spark, tmp_path):
    source = tmp_path / "items"
    held = MaintainedTotals(spark, f"{tmp_path}/totals", str(source), ("product_id",), "amount")
    items(spark, str(source), [(1, 2.0), (2, 5.0), (None, 1.0)])
    first = held.refresh()
    assert first.stale and first.pending_files == 1 and not held.staleness().stale
    # what has been folded in becomes unreadable, its listing as before
    for old in parts(source):
        kept = old.stat()
        old.write_bytes(b"?" * kept.st_size)
        os.utime(old, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert not held.refresh().stale
    items(spark, str(source), [(1, 3.0), (7, 4.0)])
    behind = held.staleness()
    assert behind.stale and behind.pending_files == 1 and behind.pending_bytes > 0 and not behind.rebuild
    held.refresh()
    want = [(1, 2, 5.0, 2.0, 3.0), (2, 1, 5.0, 5.0, 5.0), (7, 1, 4.0, 4.0, 4.0), (None, 1, 1.0, 1.0, 1.0)]
    assert rows_of(held.read(), "product_id", "rows", "total", "low", "high") == sorted(want, key=repr)
    # another object, as in a later session, finds the same state
    again = MaintainedTotals(spark, f"{tmp_path}/totals", str(source), ("product_id",), "amount")
    assert not again.staleness().stale and again.read().count() == 4


def test_replaced_files_ask_for_a_rebuild(spark, tmp_path):
    source = tmp_path / "items"
    held = MaintainedTotals(spark, f"{tmp_path}/totals", str(source), ("product_id",), "amount", lambda r: r.where("amount > 1"))
    with pytest.raises(LookupError):
        held.read()
    items(spark, str(source), [(1, 2.0), (1, 1.0)])
    held.refresh()
    items(spark, str(source), [(1, 9.0), (3, 1.5), (3, 0.5)], "overwrite")
    assert held.staleness().rebuild
    assert held.refresh().rebuild and not held.staleness().stale
    assert rows_of(held.read(), "product_id", "rows", "total") == [(1, 1, 9.0), (3, 1, 1.5)]


def test_a_refresh_that_failed_is_repeated(spark, tmp_path):
    source = tmp_path / "items"
    held = MaintainedTotals(spark, f"{tmp_path}/totals", str(source), ("product_id",), "amount")
    items(spark, str(source), [(1, 2.0)])
    held.refresh()
    items(spark, str(source), [(1, 3.0)])
    spark.createDataFrame([(1, 99)], "product_id long, rows long").write.parquet(held._version(1))  # begun, not finished
    assert rows_of(held.read(), "total") == [(2.0,)]
    held.refresh()
    assert rows_of(held.read(), "rows", "total") == [(2, 5.0)]
    assert held.read().agg(F.count("*")).first()[0] == 1
