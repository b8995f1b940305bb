"""The entities over the stored tables."""

from pyspark.sql import functions as F

from cartloom.model import DEALT_ROWS, Model
from cartloom.plans import load_all
from cartloom.plans.registry import QUERIES

load_all()


def test_tasks_of_a_dealt_scan_grow_with_its_rows(spark, tmp_path):
    spark.range(9_000_000).select(F.col("id").alias("l_orderkey")).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1000).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    m = Model(spark, str(tmp_path))
    per_task = [r["count"] for r in m.table("lineitem", deal_by="l_orderkey").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 9_000_000 and max(per_task) < 1.1 * DEALT_ROWS
    assert m.table("orders", deal_by="o_orderkey").rdd.getNumPartitions() == 8


def test_join_composite_of_many_and_few_rows_to_a_task(spark, tmp_path, monkeypatch):
    lines = spark.range(3000).selectExpr(
        "nullif(id % 211, 7) AS l_orderkey", "id % 3 AS l_partkey", "id % 2 AS l_suppkey", "CAST(id % 5 AS int) AS l_linenumber",
        "double(id % 50) AS l_quantity", "double(id % 97) AS l_extendedprice", "double(id % 10) / 100 AS l_discount", "0.02D AS l_tax",
        "if(id % 4 = 0, 'R', 'N') AS l_returnflag", "'F' AS l_linestatus", "timestamp_ntz'1998-01-01 00:00:00' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    want = lines.where("l_orderkey IS NOT NULL").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("refunds"), F.sum("l_quantity").cast("long").alias("units")
    ).where("refunds > 0")
    want = {tuple(r) for r in want.collect()}
    for most in (DEALT_ROWS, 100):
        monkeypatch.setattr("cartloom.model.DEALT_ROWS", most)
        out = QUERIES["join_composite"](spark, str(tmp_path)).collect()
        got = {(r.order_id, r.product_id, r.supplier_id, r.refunds, r.units) for r in out}
        assert got == want and len(out) == len(want) > 100
