"""The table function over monthly rows."""

import datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from helpers import rows_of

from cartloom.functions.history import BATCH_ROWS, MonthlyHistory, monthly_history


def at(year, month):
    return datetime.datetime(year, month, 1)


def test_months_are_filled_and_streaks_counted(spark):
    rows = [
        (1, at(2023, 11), 2, 5.0, "x"), (1, at(2023, 12), 1, 1.0, "y"), (1, at(2024, 2), 3, 2.0, None), (2, at(2024, 5), 0, 0.0, "z"),
        (None, at(2024, 1), 1, 1.0, "n"), (None, at(2024, 2), 1, 1.0, "n"), (3, None, 4, 4.0, "w"), (3, at(2024, 1), 4, 4.0, "w"),
    ]
    df = spark.createDataFrame(rows, "who long, at timestamp_ntz, n long, spent double, note string")
    out = monthly_history(df, "who", "at", "n")
    assert out.columns == ["who", "at", "n", "spent", "note", "streak"]
    assert rows_of(out, "who", "at", "n", "spent", "note", "streak") == sorted([
        (1, at(2023, 11), 2, 5.0, "x", 1), (1, at(2023, 12), 1, 1.0, "y", 2), (1, at(2024, 1), 0, 0.0, None, 0), (1, at(2024, 2), 3, 2.0, None, 1),
        (2, at(2024, 5), 0, 0.0, "z", 0), (None, at(2024, 1), 1, 1.0, "n", 1), (None, at(2024, 2), 1, 1.0, "n", 2),
        (3, None, 4, 4.0, "w", None), (3, at(2024, 1), 4, 4.0, "w", 1),
    ], key=repr)
    assert monthly_history(df.where("false"), "who", "at", "n").count() == 0


def test_two_callers_and_other_tables(spark):
    a = spark.createDataFrame([("k", at(2024, 1), 1), ("k", at(2024, 3), 1)], "key string, month timestamp_ntz, seen int")
    b = spark.createDataFrame([(datetime.date(2024, 1, 1), 7)], "m date, amount int").selectExpr("1 AS `the key`", "*")
    first, second = monthly_history(a, "key", "month", "seen"), monthly_history(b, "the key", "m", "amount")
    assert rows_of(second, "the key", "m", "amount", "streak") == [(1, datetime.date(2024, 1, 1), 7, 1)]
    assert rows_of(first, "month", "streak") == [(at(2024, 1), 1), (at(2024, 2), 0), (at(2024, 3), 1)]
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and "month" in t.name]


def test_unknown_columns_are_refused(spark):
    df = spark.createDataFrame([(1, at(2024, 1), 1)], "who long, at timestamp_ntz, n long")
    with pytest.raises(Exception, match="lacks"):
        monthly_history(df, "who", "at", "nothing").collect()


def by_row(rows):
    """The plain rule, a row at a time: (key, month, n, note) in, the same and the streak out."""
    out, last = [], {}
    for key, month, n, note in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or at(1, 1))):
        if month is None:
            out.append((key, month, n, note, None))
            continue
        before, streak = last.get(key, (None, 0))
        number = before + 1 if before is not None else month.year * 12 + month.month - 1
        while number < month.year * 12 + month.month - 1:
            out.append((key, at(number // 12, number % 12 + 1), None if n is None else 0, None, 0))
            number, streak = number + 1, 0
        streak = streak + 1 if (n or 0) > 0 else 0
        last[key] = (month.year * 12 + month.month - 1, streak)
        out.append((key, month, n, note, streak))
    return sorted(out, key=repr)


def test_many_keys_in_batches_as_by_row(spark):
    rows = []
    for k in range(300):
        months = sorted({(k * 7 + i * i * (k % 5 + 1)) % 90 for i in range(k % 13)})
        rows += [(k or None, at(1968 + m // 12, m % 12 + 1), [2, 1, 0, None][(k + m) % 4 if k % 2 else 0], str(m)) for m in months]
        rows += [(k or None, None, k, "none")] * (k % 11 == 0)
    df = spark.createDataFrame(rows, "who long, at timestamp_ntz, n int, note string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (before, "5"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert rows_of(monthly_history(df, "who", "at", "n"), "who", "at", "n", "note", "streak") == by_row(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_batch_of_keys_is_one_call_and_results_come_in_bounded_batches():
    call = MonthlyHistory()
    args = [pa.array([name]) for name in ("who", "at", "n")]
    first = pa.record_batch({"who": [1, 1, 2, 2], "at": [at(2024, 1), at(2024, 4), at(2024, 1), at(2024, 2)], "n": [1, 1, 1, 1]})
    (out,) = call.eval(first, *args)
    assert out.column("who").to_pylist() == [1, 1, 1, 1, 2, 2] and out.column("streak").to_pylist() == [1, 0, 0, 1, 1, 2]
    second = pa.record_batch({"who": [2, 2, 3], "at": [at(2024, 3), at(9999, 12), at(2024, 3)], "n": [1, 1, 1]})
    parts = list(call.eval(second, *args))
    streaks = [s for p in parts for s in p.column("streak").to_pylist()]
    assert len(parts) == 2 and max(p.num_rows for p in parts) == BATCH_ROWS
    assert streaks == [3, *[0] * (7975 * 12 + 8), 1, 1]


def test_types_of_the_month_and_of_what_is_filled(spark):
    days = [((1,), datetime.date(2023, 12, 3)), ((1,), datetime.date(2024, 2, 3)), ((2,), datetime.date(2024, 5, 31))]
    df = spark.createDataFrame([(*r, True, Decimal(2), [1], 1.5) for r in days], "k struct<x int>, m date, b boolean, d decimal(9,2), a array<int>, f float")
    df = df.selectExpr("*", "CAST(m AS timestamp) AS t", "CAST(m AS timestamp_ntz) AS u")
    for month in ("m", "t", "u"):
        for active in ("b", "d", "f"):
            out = [r for r in monthly_history(df, "k", month, active).collect() if r.k[0] == 1]
            assert [(r[month].year, r[month].month, r[month].day, r.streak) for r in out] == [(2023, 12, 3, 1), (2024, 1, 3, 0), (2024, 2, 3, 1)]
            assert (out[1].b, out[1].d, out[1].a, out[1].f) == (None, None, None, 0.0)
