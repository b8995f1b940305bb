"""Operators on small written tables."""

import random

import pytest
from helpers import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartloom.functions import text, udfs
from cartloom.operators import changes, distinct, evolve, layout, metering, protect, quality, rewrite
from cartloom.operators.groups import Order
from cartloom.operators.hierarchy import walk
from cartloom.operators.rewrite import Clause


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# --- row changes -------------------------------------------------------------------


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, "b", None)], "id int, name string, price double")


def test_insert_update_delete(products):
    spark = products.sparkSession
    more = rewrite.insert_rows(products, spark.createDataFrame([(3, "c")], "id int, name string"))
    assert rows_of(more) == [(1, "a", 10.0), (2, "b", None), (3, "c", None)]
    with pytest.raises(ValueError):
        rewrite.insert_rows(products, spark.createDataFrame([(3, "c")], "id int, colour string"))
    seen = Observation()
    up = rewrite.update_where(products, F.col("price") > 5, {"price": F.col("price") * 2}, seen)
    assert rows_of(up) == [(1, "a", 20.0), (2, "b", None)]
    assert seen.get["rows_updated"] == 1
    # A NULL test deletes nothing.
    assert rows_of(rewrite.delete_where(products, F.col("price") > 5), "id") == [(2,)]


def test_merge_updates_and_inserts(products):
    source = products.sparkSession.createDataFrame([(1, 99.0), (99999, 5.0)], "id int, price double")
    done = rewrite.upsert(products, source, ["id"], keep_action=True)
    assert rows_of(done, "id", "name", "price", "_action") == [
        (1, "a", 99.0, "update"), (2, "b", None, "keep"), (99999, None, 5.0, "insert")
    ]
    again = rewrite.upsert(rewrite.upsert(products, source, ["id"]), source, ["id"])
    assert rows_of(again) == rows_of(done.drop("_action"))


def test_merge_refuses_a_key_twice(products):
    source = products.sparkSession.createDataFrame([(1, 1.0), (1, 2.0)], "id int, price double")
    with pytest.raises(PySparkException, match="more than once"):
        rewrite.upsert(products, source, ["id"]).collect()


def test_merge_takes_the_first_clause(products):
    source = products.sparkSession.createDataFrame([(1, 1.0), (3, 3.0), (4, 4.0)], "id int, price double")
    done = rewrite.merge(
        products, source, ["id"],
        matched=[Clause("delete", F.col("s.price") < 2), Clause("update", sets={"price": F.col("s.price")})],
        not_matched=[Clause("insert", F.col("s.price") > 3, {"price": F.col("s.price")})],
        not_matched_by_source=[Clause("update", F.col("t.price").isNull(), {"name": F.lit("gone")})],
    )
    assert rows_of(done) == [(2, "gone", None), (4, None, 4.0)]


def test_audited_publish(products, tmp_path):
    spark = products.sparkSession
    ok, n = rewrite.audited_publish(products, F.col("price") > 5, 0, 0, f"{tmp_path}/out")
    assert (ok, n) == (False, 1) and not (tmp_path / "out").exists()
    ok, n = rewrite.audited_publish(products, F.col("price") > 5, 1, 1, f"{tmp_path}/out")
    assert (ok, n) == (True, 1) and rows_of(spark.read.parquet(f"{tmp_path}/out")) == rows_of(products)


# --- change feeds and history --------------------------------------------------------


def test_change_feed_and_apply(spark):
    ddl = "id int, status string, total double"
    old = spark.createDataFrame([(1, "placed", 1.0), (2, "placed", None), (3, "shipped", 3.0)], ddl)
    new = spark.createDataFrame([(1, "shipped", 1.0), (2, "placed", None), (4, "placed", 4.0)], ddl)
    feed = changes.change_feed(old, new, ["id"])
    assert rows_of(feed, "id", "status", "action", "is_update") == [
        (1, "placed", "DELETE", True), (1, "shipped", "INSERT", True), (3, "shipped", "DELETE", False), (4, "placed", "INSERT", False)
    ]
    assert feed.select("row_id").distinct().count() == 3
    once = changes.apply_changes(old, feed, ["id"])
    assert rows_of(once) == rows_of(new)
    assert rows_of(changes.apply_changes(once, feed, ["id"])) == rows_of(new)
    assert changes.change_feed(new, new, ["id"]).isEmpty()
    assert rows_of(changes.appended(old, new, ["id"]), "id") == [(4,)]


def test_last_change_of_a_key_counts(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    feed = spark.createDataFrame(
        [(1, "b", "INSERT", True, 1), (1, "c", "INSERT", True, 2), (2, "x", "INSERT", False, 1), (2, "x", "DELETE", False, 2)],
        "id int, v string, action string, is_update boolean, round int",
    )
    assert rows_of(changes.apply_changes(target, feed, ["id"], [Order("round")])) == [(1, "c")]
    with pytest.raises(PySparkException, match="more than once"):
        changes.apply_changes(target, feed, ["id"]).collect()


def test_as_of_and_repair(spark):
    log = spark.createDataFrame(
        [(1, "new", "INSERT", 10, 1), (2, "new", "INSERT", 10, 2), (1, "old", "INSERT", 20, 3), (2, "new", "DELETE", 30, 4)],
        "id int, v string, action string, changed_at int, change_id int",
    )
    at = lambda t: rows_of(changes.as_of_state(log, ["id"], at=F.lit(t)))
    assert at(5) == [] and at(10) == [(1, "new"), (2, "new")] and at(25) == [(1, "old"), (2, "new")] and at(30) == [(1, "old")]
    assert rows_of(changes.as_of_state(log, ["id"], before_change=4)) == at(25)
    now, before = changes.as_of_state(log, ["id"]), changes.as_of_state(log, ["id"], at=F.lit(10))
    assert rows_of(changes.restore_values(now, before, ["id"], ["v"])) == [(1, "new")]
    assert rows_of(changes.recover_deleted(now, before, ["id"])) == [(1, "old"), (2, "new")]


def test_incremental_totals_equal_a_recompute(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") * 1.0).alias("v"), "id")
    stored = changes.totals(df.filter("id < 60"), ["k"], "v")
    stored = changes.merge_totals(stored, df.filter("id BETWEEN 60 AND 79"), ["k"], "v")
    stored = changes.merge_totals(stored, df.filter("id > 79"), ["k"], "v")
    assert rows_of(stored) == rows_of(changes.totals(df, ["k"], "v"))


# --- schema change, quality, trees -----------------------------------------------------


def test_schema_change(products):
    wide = evolve.widen(products, {"id": "bigint"})
    assert dict(wide.dtypes)["id"] == "bigint"
    for column, kind in (("price", "int"), ("name", "int"), ("id", "smallint")):
        with pytest.raises(ValueError, match="without loss"):
            evolve.widen(products, {column: kind})
    with pytest.raises(ValueError):
        evolve.rename(products, {"nothing": "x"})
    with pytest.raises(ValueError):
        evolve.add_columns(products, {"price": ("int", 0)})
    r = evolve.retype(products.withColumn("name", F.when(F.col("id") == 1, "17").otherwise("x")), "name", "int")
    assert rows_of(r, "id", "name", "rejected") == [(1, 17, None), (2, None, "x")]


def test_strict_cast_raises(spark):
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        spark.range(1).select(F.lit("not_a_number").cast("double")).collect()


def test_dead_letter_reasons(spark):
    rows = [(1, 1, "placed"), (2, None, "pending"), (3, 3, "lost"), (4, None, "lost"), (5, 5, None)]
    df = spark.createDataFrame(rows, "id int, customer_id int, status string")
    rules = [
        (F.col("customer_id").isNull(), "missing customer_id"),
        (~F.col("status").isin("placed", "pending"), "unrecognized order_status"),
    ]
    good, bad = quality.route(df, rules)
    assert rows_of(good, "id") == [(1,), (5,)]
    assert rows_of(bad, "id", "reason") == [
        (2, "missing customer_id"), (3, "unrecognized order_status"), (4, "missing customer_id")
    ]


# The category example.
CATEGORIES = [
    (1, "Electronics", None), (2, "Computers", 1), (3, "Laptops", 2), (4, "Gaming Laptops", 3),
    (5, "Phones", 2), (6, "Clothing", None), (7, "Mens", 6), (8, "Womens", 6),
]


def test_category_tree(spark):
    tree = walk(spark.createDataFrame(CATEGORIES, "id int, name string, parent int"), "id", "parent", "name")
    got = {r["id"]: (r["depth"], r["path"], r["indented"]) for r in tree.collect()}
    assert len(got) == 8
    assert got[4] == (3, "Electronics > Computers > Laptops > Gaming Laptops", "      Gaming Laptops")
    assert got[5] == (2, "Electronics > Computers > Phones", "    Phones")


def test_a_cycle_is_reported(spark):
    loop = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 4), (4, "d", 3)], "id int, name string, parent int")
    with pytest.raises(ValueError, match="2 nodes: their parents form a cycle"):
        walk(loop, "id", "parent", "name")
    twice = spark.createDataFrame([(1, "a", None), (2, "b", 1), (2, "b", 1)], "id int, name string, parent int")
    with pytest.raises(ValueError, match="more than once"):
        walk(twice, "id", "parent", "name")


def test_deep_chains_take_few_rounds(spark, monkeypatch):
    from cartloom.operators import hierarchy

    rounds = []
    plain = hierarchy.attach
    monkeypatch.setattr(hierarchy, "attach", lambda *a, **k: (rounds.append(1), plain(*a, **k))[1])
    n = 2500
    chain = spark.range(n).select(F.col("id"), F.lit("x").alias("name"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    tree = hierarchy.walk(chain, "id", "parent", "name", "").select("id", "depth", F.length("path").alias("size"))
    assert tree.where("depth <> id OR size <> id + 1").isEmpty() and tree.count() == n
    assert len(rounds) <= 12


def test_random_forest_and_missing_parents(spark):
    rng = random.Random(8)
    up = {k: None if k < 3 else rng.choice([rng.randrange(k), 0]) for k in range(120)}
    rows = [(k, f"n{k}", p) for k, p in up.items()]

    def path(k):
        return ([] if up[k] is None else path(up[k])) + [f"n{k}"]

    got = walk(spark.createDataFrame(rows, "id int, name string, parent int"), "id", "parent", "name", "/").collect()
    assert {r["id"]: (r["depth"], r["path"]) for r in got} == {k: (len(path(k)) - 1, "/".join(path(k))) for k in up}
    lost = rows + [(500, "a", 501), (502, "b", 500), (503, "c", 504), (504, "d", 505), (505, "e", 503), (506, "f", 505)]
    with pytest.raises(ValueError, match="no root reaches 6 nodes"):
        walk(spark.createDataFrame(lost, "id int, name string, parent int"), "id", "parent", "name")
    assert walk(spark.createDataFrame([], "id int, name string, parent int"), "id", "parent", "name").count() == 0


def test_distinct_counts_and_sketches(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, -5, 0, 70_000, rng.randrange(-40_000, 90_000)]), rng.choice([None, "x", "y", str(rng.random())])) for _ in range(4000)]
    rows += [("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, n long, s string")
    names, size = {"numbers": "n", "texts": "s"}, lambda g, k: len({r[k] for r in rows if r[k] is not None and (g is ... or r[0] == g)})
    all_ = distinct.distinct_counts(df, names, dense=["n"])
    assert [tuple(r) for r in all_.collect()] == [(size(..., 1), size(..., 2))]
    assert "Expand" not in all_._jdf.queryExecution().optimizedPlan().toString()
    per = distinct.distinct_counts(df, names, dense=["n"], by=["g"])
    assert {r["g"]: (r["numbers"], r["texts"]) for r in per.collect()} == {g: (size(g, 1), size(g, 2)) for g in ("a", "b", None, "empty")}
    assert [tuple(r) for r in distinct.distinct_counts(df.where("false"), names, dense=["n"]).collect()] == [(0, 0)]
    days = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 20_000).alias("k"))
    stored = distinct.sketches(days, "day", "k")
    about = {r["half"]: r["estimate"] for r in distinct.merged(stored.withColumn("half", F.col("day") < 15), "half").collect()}
    exact = {r["half"]: r["n"] for r in days.groupBy((F.col("day") < 15).alias("half")).agg(F.count_distinct("k").alias("n")).collect()}
    assert all(abs(about[h] - exact[h]) <= 0.05 * exact[h] for h in exact)


# --- functions ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("555-123-4567", "(555) 123-4567"), ("(555) 123-4567", "(555) 123-4567"), ("5551234567", "(555) 123-4567"),
        ("+1 555 123 4567", "15551234567"), ("invalid", None), (None, None),
    ],
)
def test_clean_phone(spark, raw, clean):
    assert one(spark, udfs.clean_phone(F.lit(raw).cast("string"))) == clean


def test_scalar_rules(spark):
    assert one(spark, udfs.margin_pct(F.lit(100.0), F.lit(60.0))) == 40.0
    assert one(spark, udfs.margin_pct(F.lit(0.0), F.lit(60.0))) is None
    udfs.register_sql_functions(spark)
    assert spark.sql("SELECT gross_margin_pct(100.0, 60.0)").first()[0] == 40.0
    assert one(spark, udfs.customer_score(F.lit(5), F.lit(1250.0), F.lit(180))) == 152.5
    assert one(spark, udfs.format_currency(F.lit(1234.56))) == "$1,234.56"
    assert one(spark, udfs.format_currency(F.lit(1000))) == "$1,000.00"
    for email, domain in (("A@Example.COM", "example.com"), ("a@b@c", None), ("none", None), ("", None)):
        assert one(spark, udfs.email_domain(F.lit(email))) == domain
    assert one(spark, udfs.status_label(F.lit("cancelled"))) == "Cancelled"
    assert one(spark, udfs.status_label(F.lit("?"))) == "Unknown Status"
    tier = lambda x: one(spark, udfs.order_tier(F.lit(x), [(1000, "enterprise"), (500, "premium"), (100, "standard")], "micro"))
    assert [tier(x) for x in (1000, 999, 100, 1)] == ["enterprise", "premium", "standard", "micro"]


def test_custom_aggregate_merges_partials(spark):
    df = spark.range(1000).repartition(7).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.0).alias("v"))

    def partial(pdf):
        return pdf.assign(s=pdf.v, n=1).groupby("k", as_index=False)[["s", "n"]].sum()

    got = udfs.custom_aggregate(df, ["k"], "s double, n bigint", partial, {"mean": F.sum("s") / F.sum("n")})
    assert rows_of(got, "k", "mean") == rows_of(df.groupBy("k").agg(F.avg("v").alias("mean")), "k", "mean")


def test_text_scores(spark):
    df = spark.createDataFrame(
        [(1, "Great product, LOVE it! Terrible box."), (2, "broken; awful"), (3, "nothing here"), (4, "great-great delivery price price")],
        "id int, t string",
    ).select("id", text.words(F.col("t")).alias("w"))
    s = df.select("id", text.sentiment(F.col("w")).alias("s")).orderBy("id").collect()
    assert [round(r["s"], 3) for r in s] == [0.333, -1.0, 0.0, 1.0]
    labels = {"shipping": ["delivery", "box"], "price": ["price", "great"]}
    c = df.select("id", text.classify(F.col("w"), labels, "other").alias("c")).orderBy("id").collect()
    assert [r["c"] for r in c] == ["shipping", "other", "other", "price"]  # first label wins a tie
    assert rows_of(df.filter(text.mentions(F.col("w"), ["awful", "box"])), "id") == [(1,), (2,)]


# --- protection ------------------------------------------------------------------------------


def test_masks(spark):
    for mask, raw, want in (
        (protect.full, "x", "***MASKED***"), (protect.last_four, "555-123-4567", "***-***-4567"),
        (protect.first_letter, "Anna", "A***"), (protect.short_email, "john.doe@example.com", "jo***@example.com"),
        (protect.short_email, "no address", "***MASKED***"),
    ):
        assert one(spark, mask(F.lit(raw))) == want
    for mask in protect.MASKS.values():
        assert one(spark, mask(F.lit(None).cast("string"))) is None


def test_roles_and_rows(spark):
    assert protect.held_roles("m", {"m": ["r"], "r": ["a", "m"]}) == {"m", "r", "a"}
    data = spark.createDataFrame([(1, "EU"), (2, "US"), (3, "ASIA")], "id int, region string")
    access = spark.createDataFrame([("eu", "EU"), ("us", "US"), ("both", "EU"), ("both", "US")], "role string, value string")
    see = lambda *roles: [i for (i,) in rows_of(protect.row_filter(data, access, "region", set(roles), {"manager"}), "id")]
    assert see("eu") == [1] and see("both", "eu") == [1, 2] and see("manager") == [1, 2, 3] and see("intern") == []


def test_mask_then_join_is_join_then_mask(spark):
    people = spark.createDataFrame([(1, "a@b.c"), (2, "dd@e.f")], "id int, email string")
    orders = spark.createDataFrame([(1, 5.0), (1, 6.0), (2, 7.0)], "id int, total double")
    mask = lambda df: protect.mask_columns(df, {"email": "short_email"}, {"x"}, {"auditor"})
    assert rows_of(mask(people).join(orders, "id")) == rows_of(mask(people.join(orders, "id")))
    assert protect.mask_columns(people, {"email": "full"}, {"auditor"}, {"auditor"}) is people


def test_untagged_types_are_removed(spark):
    df = spark.createDataFrame([(1, "n", 2.5)], "id int, name string, pay double")
    got = protect.mask_by_tag(df, {"name": "pii", "pay": "pii"}, {("pii", "string"): "full"}, {"x"}, {"auditor"})
    assert got.columns == ["id", "name"] and got.first()["name"] == protect.HIDDEN


def test_noise_is_centred(spark):
    df = spark.range(4000).select((F.col("id") % 400).alias("g"))
    noisy = protect.noisy_counts(df, "g", epsilon=1.0, seed=5)
    assert abs(noisy.agg(F.avg("noisy_count")).first()[0] - 10) < 0.5


# --- metering --------------------------------------------------------------------------------


def test_a_minute_is_the_least_billed(spark):
    log = spark.createDataFrame([(0, 0), (1, 12), (2, 5000), (3, 5100), (4, 5200)], "id int, s int")
    log = log.select(F.lit("w").alias("res"), F.timestamp_seconds("s").cast("timestamp_ntz").alias("at"), "id")
    b = metering.billed(metering.sessions(log, "res", "at", "id", 600), F.lit(0.0)).orderBy("started_at").collect()
    assert [(r["billed_seconds"], r["actions"]) for r in b] == [(60, 2), (200, 3)]
    assert b[0]["credits"] == round(60 / 3600, 6)


# --- layout ----------------------------------------------------------------------------------


def ranges(spark, tmp_path, pairs):
    for i, (lo, hi) in enumerate(pairs):
        spark.createDataFrame([(lo,), (hi,)], "x int").coalesce(1).write.mode("append").parquet(str(tmp_path))
    return spark.read.parquet(str(tmp_path))


def test_clustering_report(spark, tmp_path):
    apart = layout.clustering_report(ranges(spark, tmp_path / "a", [(0, 10), (20, 30), (40, 50)]), "x").first()
    assert (apart["files"], apart["avg_overlaps"], apart["avg_depth"]) == (3, 0.0, 1.0)
    same = layout.clustering_report(ranges(spark, tmp_path / "b", [(0, 10)] * 4), "x").first()
    assert (same["files"], same["avg_overlaps"], same["avg_depth"]) == (4, 3.0, 4.0)
    # 0-10 and 5-15 overlap over a third of the covered range; 20-25 stands alone.
    mixed = layout.clustering_report(ranges(spark, tmp_path / "c", [(0, 10), (5, 15), (20, 25)]), "x").first()
    assert (mixed["avg_overlaps"], mixed["avg_depth"]) == (round(2 / 3, 4), round(25 / 20, 4))
    constant = layout.clustering_report(ranges(spark, tmp_path / "d", [(7, 7), (7, 7)]), "x").first()
    assert (constant["avg_overlaps"], constant["avg_depth"]) == (1.0, 2.0)


def test_rewrite_prunes(spark, tmp_path):
    df = spark.range(10000).select((F.col("id") * 7919 % 10007).alias("x"), "id").repartition(8)
    df.write.parquet(f"{tmp_path}/before")
    before = spark.read.parquet(f"{tmp_path}/before")
    after = layout.cluster_rewrite(before, f"{tmp_path}/after", ["x", "id"], 8)
    assert rows_of(after) == rows_of(before)
    n = lambda t: layout.pruning_report(t, "x", 100, 200).first()["files_scanned"]
    assert n(before) == 8 and n(after) <= 2
    assert layout.clustering_report(after, "x").first()["avg_overlaps"] == 0.0


def test_rewrite_with_bloom_keeps_rows(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 50).alias("x"), "id")
    t = layout.cluster_rewrite(df, f"{tmp_path}/t", ["id"], 8, bloom="id")
    assert rows_of(t) == rows_of(df) and len(t.inputFiles()) == 8
    assert rows_of(t.filter(F.col("id") == 17), "id") == [(17,)]
    assert t.filter(F.col("id") == -1).isEmpty()


def test_file_count_follows_bytes(spark):
    small, large = spark.range(1000), spark.range(100_000_000)
    assert layout.files_for(small, 3) == 3
    assert layout.files_for(large) == -(-800_000_000 // layout.FILE_BYTES)


def test_row_ids_tell_keys_apart(spark):
    ddl = "a string, b string, v int"
    new = spark.createDataFrame([("x|y", "z", 1), ("x", "y|z", 2), ("x", None, 3), (None, "x", 4)], ddl)
    added = changes.appended(new.limit(0), new, ["a", "b"])
    assert added.select("row_id").distinct().count() == 4
