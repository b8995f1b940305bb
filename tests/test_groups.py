"""The split plans for large groups give what the ordinary plans give."""

import pytest
from helpers import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.operators import groups, metering, rewrite
from cartloom.operators.groups import Neighbour, Order, Position, Running

HOT = 40  # a third of the rows belong to one key


@pytest.fixture(scope="module")
def table(spark):
    # Key 0 holds half of the rows, many of them with equal order values; key NULL
    # is hot as well; one value in seven is NULL.
    r = spark.range(600)
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 29)
    at = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 101)
    v = F.when(F.col("id") % 7 != 0, F.col("id") % 13)
    df = r.select("id", key.alias("k"), at.alias("at"), v.alias("v"))
    return df.repartition(5).cache()


OUTPUTS = [Position("n"), Running("total", "v"), Neighbour("before", "v", -1), Neighbour("after", "at", 1)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_in_order(table, keys, descending):
    order = [Order("at", descending), Order("id")]
    plain = groups.in_order(table, keys, order, OUTPUTS)
    split = groups.in_order(table, keys, order, OUTPUTS, hot_rows=HOT)
    assert "_piece" not in split.columns
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("keys", [["k"], []])
def test_ranked(table, keys):
    by = Order("at", True)
    assert rows_of(groups.ranked(table, keys, by, hot_rows=HOT)) == rows_of(groups.ranked(table, keys, by))


def test_rank_example(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([5, 4, 4, 3, 2])], "id int, s int")
    for hot in (None, 2):
        r = groups.ranked(df, [], Order("s", True), hot_rows=hot).orderBy(F.desc("s"), "id").collect()
        assert [x["rank"] for x in r] == [1, 2, 2, 4, 5]
        assert [x["dense_rank"] for x in r] == [1, 2, 2, 3, 4]
        n = groups.in_order(df, [], [Order("s", True), Order("id")], [Position("n")], hot_rows=hot)
        assert sorted(x["n"] for x in n.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("n", [1, 4, 7, 1000])
def test_tiles(spark, table, n):
    df = table.filter("k IS NOT NULL")
    for keys in (["k"], []):
        order = [Order("at"), Order("id")]
        split = groups.tiles(df, keys, order, n, "tile", hot_rows=HOT)
        assert rows_of(split) == rows_of(groups.tiles(df, keys, order, n, "tile"))


def test_attach_spreads_and_keeps(table):
    df = table.filter("k IS NOT NULL")
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.sum("v").alias("sum"))
    joined = groups.attach(df, stats, ["k"], "size", ["id"], hot_rows=HOT)
    assert rows_of(joined) == rows_of(df.join(stats, "k"))
    few = stats.filter("k > 20")
    left = groups.attach(df, few, ["k"], "size", ["id"], hot_rows=HOT, how="left")
    assert rows_of(left) == rows_of(df.join(few, "k", "left"))


def test_newest_and_best(table):
    w = Window.partitionBy("k").orderBy(F.desc_nulls_first("at"), F.desc("id"))
    want = table.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")
    got = groups.newest(table, ["k"], [Order("at"), Order("id")])
    # One limit per group runs before the shuffle, one after it.
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows_of(got) == rows_of(want)


def test_first_rows(table):
    order = [Order("at", True), Order("id")]
    for k in (1, 50, 299, 10_000):
        want = [r["id"] for r in table.orderBy(F.desc("at"), "id").limit(k).collect()]
        for hot in (None, HOT, 5):
            got = groups.first_rows(table, order, k, F.col("at"), newest_first=True, hot_rows=hot)
            assert [r["id"] for r in got.collect()] == want
        up = groups.first_rows(table, [Order("at"), Order("id")], k, F.col("at"), newest_first=False, hot_rows=HOT)
        assert [r["id"] for r in up.collect()] == [r["id"] for r in table.orderBy("at", "id").limit(k).collect()]


def test_dense_ids(spark):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("x"))
    ids = groups.dense_ids(df, [Order("x")], "key", start=1000).orderBy("x").collect()
    assert [r["key"] for r in ids] == list(range(1000, 1100))


def test_update_matching_hot_key(table):
    members = table.filter("k IN (0, 3)")
    for hot in (None, HOT):
        got = rewrite.update_matching(table, members, "k", "id", {"v": F.lit(-1)}, hot_rows=hot)
        want = table.withColumn("v", F.when(F.col("k").isin(0, 3), -1).otherwise(F.col("v")))
        assert rows_of(got) == rows_of(want)


def test_sessions_and_quota_when_one_key_is_hot(spark):
    r = spark.range(500)
    log = r.select(
        F.when(F.col("id") % 3 != 0, "a").otherwise(F.concat(F.lit("b"), (F.col("id") % 9).cast("string"))).alias("res"),
        F.timestamp_seconds(F.col("id") * F.col("id") % 7001 * 31).cast("timestamp_ntz").alias("at"),
        "id",
        (F.col("id") % 10 / 10.0).alias("v"),
    )
    a = metering.sessions(log, "res", "at", "id", 120)
    b = metering.sessions(log, "res", "at", "id", 120, hot_rows=HOT)
    assert rows_of(a) == rows_of(b)
    assert a.agg(F.sum("actions")).first()[0] == 500
    quota = lambda hot: metering.quota_crossings(log, "at", "id", "v", 40.0, [50, 100], hot_rows=hot)
    assert rows_of(quota(None)) == rows_of(quota(HOT)) != []


def test_stored_stages_are_released(spark):
    import os

    from cartloom.session import durable, release, scratch

    df = durable(spark.range(3))
    assert df.count() == 3
    stage = df.inputFiles()[0].replace("file://", "")
    assert os.path.exists(stage) and os.path.dirname(scratch(spark, "x")) in stage
    release(spark)
    assert not os.path.exists(stage)


def test_null_keys_and_null_days(spark):
    t = spark.range(40).select(F.col("id"), F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("at"))
    plain = groups.tiles(t, ["k"], [Order("id")], 3, "tile")
    split = groups.tiles(t, ["k"], [Order("id")], 3, "tile", hot_rows=5)
    assert rows_of(split) == rows_of(plain) and split.count() == 40
    for newest in (True, False):
        order = [Order("at", newest), Order("id")]
        for k in (1, 5, 25, 35, 39, 50):
            want = [r["id"] for r in t.orderBy(*[o.column() for o in order]).limit(k).collect()]
            for hot in (None, 5):
                got = groups.first_rows(t, order, k, F.col("at"), newest_first=newest, hot_rows=hot)
                assert [r["id"] for r in got.collect()] == want
