"""Tiles by counted borders against ntile."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.operators import borders
from cartloom.operators.groups import Order

DAY = datetime.date(2020, 1, 1)


def table(spark, n, kind):
    rng = random.Random(n)
    number = {
        "spread": lambda: rng.gauss(0, 1e6),
        "ties": lambda: float(rng.choice([1, 1, 1, 2, 3])),
        "equal": lambda: 7.0,
        "far": lambda: rng.choice([1e300, -1e300, 0.0, rng.random()]),
        "odd": lambda: rng.choice([float("inf"), -float("inf"), float("nan"), 5e-324, 0.0]),
        "nulls": lambda: rng.choice([None, None, rng.random()]),
        "none": lambda: None,
    }[kind]
    rows = [(number(), DAY + datetime.timedelta(days=rng.randrange(5)) if rng.random() < 0.8 else None, 2**60 + 3 * k) for k in range(n)]
    return spark.createDataFrame(rows, "x double, day date, id long")


def wanted(df, order, n):
    return {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(n).over(Window.orderBy(*[o.column() for o in order]))).collect()}


@pytest.mark.parametrize("kind", ["spread", "ties", "equal", "far", "odd", "nulls", "none"])
@pytest.mark.parametrize("descending", [False, True])
def test_like_ntile(spark, monkeypatch, kind, descending):
    monkeypatch.setattr(borders, "RANGES", 16)
    monkeypatch.setattr(borders, "LISTED", 5)
    df = table(spark, 97, kind).cache()
    for order, n in (([Order("x", descending), Order("id", not descending)], 4), ([Order("day", descending), Order("x"), Order("id")], 3))[: 1 + (kind in ("ties", "nulls"))]:
        got = borders.tiles_of_all(df, order, n, "tile")
        assert {r["id"]: r["tile"] for r in got.collect()} == wanted(df, order, n)
    df.unpersist()


def test_small_tables_and_plan(spark):
    order = [Order("x"), Order("id")]
    for n in (0, 1, 2, 3, 11):
        df = table(spark, n, "spread")
        assert {r["id"]: r["tile"] for r in borders.tiles_of_all(df, order, 5, "tile").collect()} == wanted(df, order, 5)
    df = spark.range(200_000).select(F.rand(3).alias("x"), "id")
    path = df.select(F.hash("id").cast("double").alias("x"), "id")
    tiled = borders.tiles_of_all(path, order, 10, "tile")
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    sizes = [r["count"] for r in tiled.groupBy("tile").count().orderBy("tile").collect()]
    assert sizes == [20_000] * 10


def test_missing_place(spark):
    with pytest.raises(IndexError):
        borders.rows_at(table(spark, 3, "spread"), [Order("x"), Order("id")], [4])
