"""Run registered queries next to their oracle SQL and compare whole results.

    python tests/oracle_check.py [--dir DIR] [--module NAME ...] [key ...]
"""

from __future__ import annotations

import argparse
import datetime
import glob
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, Decimal)) and not isinstance(v, bool):
        return f"n{v}"
    if isinstance(v, float):
        return f"f{v!r}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def family(t: str) -> str:
    t = t.lower()
    for prefix, name in (
        ("decimal", "decimal"), ("timestamp with", "ltz"), ("timestamp_ntz", "ts"), ("timestamp", "ts"),
        ("varchar", "string"), ("integer", "int"), ("hugeint", "hugeint"), ("real", "float"),
    ):
        if t.startswith(prefix):
            return name
    return t


def database(path):
    import duckdb

    db = duckdb.connect()
    for f in glob.glob(f"{path}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return db


def compare(spark, db, path, key, fn, sql):
    """Return (ok, message, seconds, row count)."""
    t = time.time()
    try:
        df = fn(spark, path)
        kinds = {f.name: ("ltz" if f.dataType.simpleString() == "timestamp" else family(f.dataType.simpleString()))
                 for f in df.schema.fields}
        names = sorted(df.columns)
        got = [tuple(cell(r[n]) for n in names) for r in df.collect()]
    except Exception as e:  # noqa: BLE001
        return False, f"spark: {str(e)[:600]}", time.time() - t, -1
    took = time.time() - t
    if len(set(names)) != len(names):
        return False, "duplicate column names", took, len(got)
    if sql is None:
        return True, "rows only", took, len(got)
    try:
        cur = db.execute(sql)
        cols = [c[0] for c in cur.description]
        types = {c[0]: family(str(c[1])) for c in cur.description}
        order = [cols.index(n) for n in sorted(cols)]
        want = [tuple(cell(r[i]) for i in order) for r in cur.fetchall()]
    except Exception as e:  # noqa: BLE001
        return False, f"duckdb: {str(e)[:600]}", took, len(got)
    if sorted(cols) != names:
        return False, f"columns {names} vs {sorted(cols)}", took, len(got)
    drift = {n: (kinds[n], types[n]) for n in names if kinds[n] != types[n]}
    got.sort(), want.sort()
    if got != want:
        a, b = set(got), set(want)
        return False, (f"values differ: {len(got)} vs {len(want)} rows, types {drift}\n   cols {names}\n"
                       f"   spark only {sorted(a - b)[:3]}\n   duckdb only {sorted(b - a)[:3]}"), took, len(got)
    if not got:
        return False, "EMPTY on both sides", took, 0
    return True, (f"ok, types {drift}" if drift else "ok"), took, len(got)


def main():
    p = argparse.ArgumentParser()
    p.add_argument("keys", nargs="*")
    p.add_argument("--dir", default="/root/testdata/sf0.01")
    p.add_argument("--module", nargs="*", default=[])
    a = p.parse_args()
    import importlib

    from cartloom.plans.registry import ORACLE, QUERIES
    from cartloom.session import build_session

    if a.module:
        for name in a.module:
            importlib.import_module(f"cartloom.plans.{name}")
    else:
        from cartloom.plans import load_all

        load_all()
    spark = build_session("check", 8)
    db = database(a.dir)
    bad = []
    for key, fn in QUERIES.items():
        if a.keys and key not in a.keys:
            continue
        ok, msg, took, n = compare(spark, db, a.dir, key, fn, ORACLE.get(key))
        if not ok:
            bad.append(key)
        print(f"{'PASS' if ok else 'FAIL'} {key:26s} {n:7d} rows {took:6.2f}s  {msg}", flush=True)
    print("failed:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
