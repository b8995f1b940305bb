"""Data layout queries, on files written from the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.operators import layout
from cartloom.plans.joins import ts
from cartloom.plans.registry import query
from cartloom.session import scratch
from cartloom.sources import writers

# Files of a rewrite of small tables; larger ones get as many as their bytes need.
FILES = 8


def lines(m):
    return m.items().select("order_id", "product_id", "line_no", "quantity", "gross", "shipped_at")


def written(m, label, df):
    path = scratch(m.spark, label)
    df.write.parquet(path)
    return m.spark.read.schema(df.schema).parquet(path)


def by_order(m):
    """Items in files cut by order: good for orders, without meaning for products."""
    return layout.cluster_rewrite(lines(m), scratch(m.spark, "by-order"), ["order_id", "line_no"], FILES)


def by_month(m):
    """Orders in a folder per month of their date."""
    path = scratch(m.spark, "by-month")
    o = m.orders().withColumn("order_month", F.date_format("created_at", "yyyy-MM"))
    writers.partitioned(o, path, ["order_month"])
    return m.spark.read.schema(o.schema).parquet(path)


RANGES = """SELECT strftime(created_at, '%Y-%m') AS u, min({x}) AS lo, max({x}) AS hi FROM ord GROUP BY 1"""


def report_sql(column, x):
    return f"""SELECT '{column}' AS "column", (SELECT count(*) FROM {column}_r) AS files,
  (SELECT round(avg(n), 4) FROM (SELECT a.u, count(*) - 1 AS n FROM {column}_r a JOIN {column}_r b ON a.lo <= b.hi
  AND b.lo <= a.hi GROUP BY a.u)) AS avg_overlaps, (SELECT round(sum(c * w) / sum(CASE WHEN c > 0 THEN w END), 4)
  FROM (SELECT s.p, CAST(s.q - s.p AS DOUBLE) AS w, (SELECT count(*) FROM {column}_r r WHERE r.lo <= s.p AND r.hi >= s.q) AS c
  FROM (SELECT p, lead(p) OVER (ORDER BY p) AS q FROM (SELECT DISTINCT lo AS p FROM {column}_r UNION SELECT hi FROM {column}_r)) s
  WHERE s.q IS NOT NULL)) AS avg_depth"""


REPORTED = {"created_at": "epoch_us(created_at)", "order_id": "order_id", "order_total": "order_total"}


@query("clustering_report", "WITH " + ", ".join(f"{c}_r AS ({RANGES.format(x=x)})" for c, x in REPORTED.items())
       + " " + " UNION ALL ".join(report_sql(c, x) for c, x in REPORTED.items()))
def clustering_report(m):
    """Overlap and depth of three columns over folders cut by one of them."""
    t = by_month(m)
    return layout.clustering_report(t, list(REPORTED), layout.folder())


@query("pruning_report", f"""SELECT 'one month' AS predicate, count(*) AS files, count(*) FILTER (hi >= TIMESTAMP '1997-03-05' AND
  lo <= TIMESTAMP '1997-03-25') AS files_scanned, round(100e0 * count(*) FILTER (hi >= TIMESTAMP '1997-03-05' AND lo <= TIMESTAMP
  '1997-03-25') / count(*), 2) AS pct_scanned FROM ({RANGES.format(x='created_at')}) UNION ALL
  SELECT 'one total', count(*), count(*) FILTER (hi >= 250000 AND lo <= 250000), round(100e0 * count(*) FILTER (hi >= 250000
  AND lo <= 250000) / count(*), 2) FROM ({RANGES.format(x='order_total')})""")
def pruning_report(m):
    t = by_month(m)
    month = layout.pruning_report(t, "created_at", ts("1997-03-05"), ts("1997-03-25"), layout.folder())
    total = layout.pruning_report(t, "order_total", 250000.0, 250000.0, layout.folder())
    return month.withColumn("predicate", F.lit("one month")).unionByName(
        total.withColumn("predicate", F.lit("one total"))
    )


@query("cluster_rewrite")
def cluster_rewrite(m):
    """The report on products before and after a rewrite by product."""
    before = by_order(m)
    after = layout.cluster_rewrite(before, scratch(m.spark, "by-product"), ["product_id", "order_id"], FILES)
    stage = lambda df, name: layout.clustering_report(df, "product_id").withColumn("stage", F.lit(name))
    return stage(before, "before").unionByName(stage(after, "after"))


@query("cluster_rewrite_content", """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no,
  l_quantity AS quantity, l_extendedprice AS gross, l_shipdate AS shipped_at FROM lineitem""")
def cluster_rewrite_content(m):
    """A rewrite moves rows and changes none."""
    return layout.cluster_rewrite(lines(m), scratch(m.spark, "by-product"), ["product_id", "order_id"], FILES)


@query("point_lookup", """SELECT product_id, order_id, line_no, quantity, gross, shipped_at FROM item
  WHERE product_id IN (SELECT max(product_id) FROM prod UNION SELECT min(product_id) FROM prod)""")
def point_lookup(m):
    """The items of two products.  Value ranges and Bloom filters of the row groups tell
    which of them hold a product."""
    t = layout.cluster_rewrite(lines(m), scratch(m.spark, "by-product"), ["product_id", "order_id"], FILES, "product_id")
    ends = m.table("part").agg(F.min("p_partkey").alias("a"), F.max("p_partkey").alias("b")).first()
    return t.filter(F.col("product_id").isin(ends["a"], ends["b"]))


@query("substring_lookup", "SELECT product_id, product_name, category FROM prod WHERE lower(product_name) LIKE '%ring%'")
def substring_lookup(m):
    """A substring may be in any file: a plain filter on two columns and the name."""
    p = m.products().select("product_id", "product_name", "category")
    return p.filter(F.lower("product_name").contains("ring"))


@query("bloom_lookup", "SELECT order_id, product_id, quantity FROM item WHERE product_id = (SELECT max(product_id) FROM prod)")
def bloom_lookup(m):
    path = scratch(m.spark, "bloom")
    t = m.items().select("order_id", "product_id", "quantity")
    layout.write_with_bloom(t, path, "product_id", t.agg(F.approx_count_distinct("product_id")).first()[0])
    last = m.table("part").agg(F.max("p_partkey")).first()[0]
    return m.spark.read.schema(t.schema).parquet(path).filter(F.col("product_id") == last)
