"""Row changes, change feeds, history and maintained aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import rows, settled
from cartloom.operators import changes, quality, rewrite
from cartloom.operators.groups import Order, newest
from cartloom.operators.maintained import MaintainedTotals
from cartloom.operators.rewrite import Clause
from cartloom.plans import oracle as q
from cartloom.plans.joins import ts
from cartloom.plans.registry import query
from cartloom.session import durable, kept, scratch

KEY = ["order_id"]
COLUMNS = ["order_id", "customer_id", "order_status", "order_total", "created_at", "shipping_method"]
COLS = ", ".join(COLUMNS)
COPY = 1_000_000_000  # offset of the ids of copied orders


def copies(m, status, method):
    """New rows: copies of some orders under new ids."""
    o = m.orders(status).filter(F.col("shipping_method") == method)
    return o.withColumn("order_id", F.col("order_id") + COPY)


def copies_sql(status, method):
    return (
        f"SELECT order_id + {COPY} AS order_id, customer_id, order_status, order_total, created_at, shipping_method "
        f"FROM ord WHERE order_status = '{status}' AND shipping_method = '{method}'"
    )


@query("insert_rows", f"SELECT {COLS} FROM ord UNION ALL {copies_sql('placed', '2-HIGH')}")
def insert_rows(m):
    return rewrite.insert_rows(m.orders(), copies(m, "placed", "2-HIGH"))


@query("update_where", f"""SELECT order_id, customer_id, CASE WHEN order_status = 'placed' AND order_total > 200000 THEN
  'processing' ELSE order_status END AS order_status, order_total, created_at, shipping_method FROM ord""")
def update_where(m):
    test = (F.col("order_status") == "placed") & (F.col("order_total") > 200000)
    return rewrite.update_where(m.orders(), test, {"order_status": F.lit("processing")})


@query("update_from_query", f"""SELECT order_id, customer_id, order_status, order_total, created_at,
  CASE WHEN customer_id IN (SELECT customer_id FROM cust WHERE balance < 0) THEN 'hold' ELSE shipping_method END
  AS shipping_method FROM ord""")
def update_from_query(m):
    debtors = m.customers().filter(F.col("balance") < 0)
    return rewrite.update_matching(
        m.orders(), debtors, "customer_id", "order_id", {"shipping_method": F.lit("hold")}
    )


@query("delete_where", f"""SELECT {COLS} FROM ord WHERE NOT (order_status = 'placed' AND order_total < 50000)""")
def delete_where(m):
    return rewrite.delete_where(m.orders(), (F.col("order_status") == "placed") & (F.col("order_total") < 50000))


def incoming(m):
    """A batch of order rows: placed orders move on, some new orders arrive."""
    moved = m.orders("placed").withColumn("order_status", F.lit("shipped"))
    return moved.unionByName(copies(m, "placed", "1-URGENT"))


INCOMING = f"""(SELECT order_id, customer_id, 'shipped' AS order_status, order_total, created_at, shipping_method FROM ord
  WHERE order_status = 'placed' UNION ALL {copies_sql('placed', '1-URGENT')})"""


@query("merge_upsert", f"""SELECT {COLS} FROM {INCOMING} UNION ALL SELECT {COLS} FROM ord
  WHERE order_id NOT IN (SELECT order_id FROM {INCOMING})""")
def merge_upsert(m):
    return rewrite.upsert(m.orders(), incoming(m), KEY)


@query("merge_conditional", f"""SELECT o.order_id, o.customer_id, CASE WHEN s.order_id IS NULL AND o.order_status = 'shipped'
  AND o.order_total > 400000 THEN 'review' WHEN s.order_id IS NOT NULL AND o.order_total >= 100000 THEN 'shipped'
  ELSE o.order_status END AS order_status, o.order_total, o.created_at, o.shipping_method, CASE WHEN s.order_id IS NOT NULL
  AND o.order_total < 100000 THEN 'delete' WHEN s.order_id IS NOT NULL THEN 'update' WHEN o.order_status = 'shipped' AND
  o.order_total > 400000 THEN 'update' ELSE 'keep' END AS action FROM ord o LEFT JOIN {INCOMING} s ON o.order_id = s.order_id
  UNION ALL SELECT {COLS}, 'insert' FROM {INCOMING} WHERE order_id >= {COPY} AND order_total > 50000""")
def merge_conditional(m):
    """Several matched clauses and one for rows the source does not have; the action
    taken is kept beside each row."""
    total = F.col("t.order_total")
    values = {c: F.col(f"s.{c}") for c in COLUMNS[1:]}
    done = rewrite.merge(
        m.orders(),
        incoming(m),
        KEY,
        matched=[Clause("delete", total < 100000), Clause("update", sets=values)],
        not_matched=[Clause("insert", F.col("s.order_total") > 50000, values)],
        not_matched_by_source=[
            Clause("update", (F.col("t.order_status") == "shipped") & (total > 400000), {"order_status": F.lit("review")})
        ],
        keep_action=True,
    )
    return done.withColumnRenamed("_action", "action")


@query("merge_dedup_source", """WITH s AS (SELECT order_id, shipped_at FROM item QUALIFY row_number() OVER
  (PARTITION BY order_id ORDER BY shipped_at DESC, line_no DESC, product_id DESC, gross DESC) = 1)
  SELECT order_id, customer_id, order_status, order_total, coalesce(shipped_at, created_at) AS created_at, shipping_method
  FROM ord LEFT JOIN s USING (order_id)""")
def merge_dedup_source(m):
    """The newest item row per order, merged into the orders."""
    i = m.items().select("order_id", "shipped_at", "line_no", "product_id", "gross")
    order = [Order("shipped_at"), Order("line_no"), Order("product_id"), Order("gross")]
    last = newest(i, KEY, order).select("order_id", F.col("shipped_at").alias("created_at"))
    return rewrite.upsert(m.orders(), last, KEY)


@query("audited_publish", """SELECT CASE WHEN n <= 100000000 THEN 'published' ELSE 'discarded' END AS outcome, n AS touched,
  (SELECT count(*) FROM ord) AS published_rows FROM (SELECT count(*) AS n FROM ord WHERE order_status = 'placed')""")
def audited_publish(m):
    path = scratch(m.spark, "orders-v2")
    test = F.col("order_status") == "placed"
    new = rewrite.update_where(m.orders().withColumn("old_status", F.col("order_status")), test, {"order_status": F.lit("closed")})
    ok, n = rewrite.audited_publish(new, F.col("old_status") == "placed", 1, 100_000_000, path)
    published = m.spark.read.schema(new.schema).parquet(path)
    return published.agg(rows().alias("published_rows")).withColumns(
        {"outcome": F.lit("published" if ok else "discarded"), "touched": F.lit(n).cast("bigint")}
    )


# --- change feed -----------------------------------------------------------------


def version_two(m):
    """The orders one round later: some gone, some moved on, some new."""
    low = (F.col("order_status") == "placed") & (F.col("shipping_method") == "5-LOW")
    rush = (F.col("order_status") == "shipped") & (F.col("shipping_method") == "1-URGENT")
    kept = rewrite.update_where(rewrite.delete_where(m.orders(), low), rush, {"order_status": F.lit("delivered")})
    return rewrite.insert_rows(kept, copies(m, "placed", "2-HIGH"))


LOW = "order_status = 'placed' AND shipping_method = '5-LOW'"
RUSH = "order_status = 'shipped' AND shipping_method = '1-URGENT'"
DELIVERED = "order_id, customer_id, 'delivered' AS order_status, order_total, created_at, shipping_method"
V2 = f"""(SELECT {COLS} FROM ord WHERE NOT ({LOW}) AND NOT ({RUSH}) UNION ALL SELECT {DELIVERED} FROM ord WHERE {RUSH}
  UNION ALL {copies_sql('placed', '2-HIGH')})"""
ROW_ID = """md5('{"order_id":' || order_id || '}') AS row_id"""


@query("change_feed", f"""SELECT {COLS}, 'DELETE' AS action, FALSE AS is_update, {ROW_ID} FROM ord WHERE {LOW}
  UNION ALL SELECT {COLS}, 'DELETE', TRUE, {ROW_ID} FROM ord WHERE {RUSH}
  UNION ALL SELECT {DELIVERED}, 'INSERT', TRUE, {ROW_ID} FROM ord WHERE {RUSH}
  UNION ALL SELECT *, 'INSERT', FALSE, {ROW_ID} FROM ({copies_sql('placed', '2-HIGH')})""")
def change_feed(m):
    return changes.change_feed(m.orders(), version_two(m), KEY)


@query("change_feed_append", f"SELECT *, 'INSERT' AS action, {ROW_ID} FROM ({copies_sql('placed', '2-HIGH')})")
def change_feed_append(m):
    return changes.appended(m.orders(), version_two(m), KEY)


@query("apply_changes", f"SELECT * FROM {V2}")
def apply_changes(m):
    feed = changes.change_feed(m.orders(), version_two(m), KEY)
    return changes.apply_changes(m.orders(), feed, KEY)


# --- rejected rows ---------------------------------------------------------------


# The order states there are.
KNOWN_STATUS = ["pending", "shipped", "delivered", "cancelled", "placed", "confirmed", "returned"]


def misspelt():
    """The status with a state that does not exist for placed orders of low priority."""
    wrong = (F.col("order_status") == "placed") & (F.col("shipping_method") == "5-LOW")
    return F.when(wrong, "plced").otherwise(F.col("order_status"))


def order_rules():
    """Checks of an order row, first failure first."""
    return [
        (F.col("customer_id").isNull(), "missing customer_id"),
        (~F.col("order_status").isin(KNOWN_STATUS), "unrecognized order_status"),
    ]


@query("dead_letter", """SELECT order_id, customer_id, order_status, created_at, CASE WHEN customer_id IS NULL THEN
  'missing customer_id' ELSE 'unrecognized order_status' END AS reason FROM (SELECT order_id, CASE WHEN order_total >= 1000
  THEN customer_id END AS customer_id, CASE WHEN order_status = 'placed' AND shipping_method = '5-LOW' THEN 'plced' ELSE
  order_status END AS order_status, created_at FROM ord) WHERE customer_id IS NULL OR order_status = 'plced'""")
def dead_letter(m):
    """Orders too small to be real carry no customer; some carry a status that does not exist."""
    o = m.orders().withColumn("order_status", misspelt())
    o = o.withColumn("customer_id", F.when(F.col("order_total") >= 1000, F.col("customer_id")))
    _, rejected = quality.route(o, order_rules())
    return rejected.select("order_id", "customer_id", "order_status", "created_at", "reason")


@query("safe_divide_route", """SELECT order_id, product_id, CAST(line_no AS BIGINT) AS line_no, gross / nullif(tax, 0) AS quotient,
  CASE WHEN tax = 0 THEN 'division by zero' END AS error FROM item""")
def safe_divide_route(m):
    """A failing row becomes NULL plus an error text instead of a failed job."""
    top, bottom = F.col("gross"), F.col("tax")
    return m.items().select(
        "order_id",
        "product_id",
        F.col("line_no").cast("bigint").alias("line_no"),
        F.try_divide(top, bottom).alias("quotient"),
        F.when(bottom == 0, "division by zero").alias("error"),
    )


# --- history -----------------------------------------------------------------------


def change_log(m):
    """Each order is inserted as placed, moves on after ten days, and low-priority
    ones that never moved are withdrawn after twenty."""
    o = m.orders()
    later = lambda days: F.col("created_at") + F.expr(f"INTERVAL {days} DAYS")
    entry = lambda df, n, action, at: df.select(
        *COLUMNS, F.lit(action).alias("action"), at.alias("changed_at"), (F.col("order_id") * 4 + n).alias("change_id")
    )
    placed = o.withColumn("order_status", F.lit("placed"))
    moved = m.orders("delivered", "shipped")
    gone = m.orders("placed").filter(F.col("shipping_method") == "5-LOW")
    return (
        entry(placed, 0, "INSERT", F.col("created_at"))
        .unionByName(entry(moved, 1, "INSERT", later(10)))
        .unionByName(entry(gone, 2, "DELETE", later(20)))
    )


SNAPSHOT_AT = "1999-06-30 12:00:00"
AT = f"TIMESTAMP '{SNAPSHOT_AT}'"
SNAPSHOT = f"""(SELECT order_id, customer_id, CASE WHEN created_at + INTERVAL 10 DAY <= {AT} THEN order_status ELSE 'placed'
  END AS order_status, order_total, created_at, shipping_method FROM ord WHERE created_at <= {AT}
  AND NOT ({LOW} AND created_at + INTERVAL 20 DAY <= {AT}))"""


def snapshot(m):
    return changes.as_of_state(change_log(m), KEY, at=ts(SNAPSHOT_AT))


def damaged(m):
    """The snapshot after a bad update of one method and a bad delete of another."""
    s = rewrite.delete_where(snapshot(m), F.col("shipping_method") == "4-NOT SPECIFIED")
    bad = F.col("shipping_method") == "3-MEDIUM"
    return rewrite.update_where(s, bad, {"order_status": F.lit("cancelled"), "order_total": F.lit(0.0)})


DAMAGED = f"""(SELECT order_id, customer_id, CASE WHEN shipping_method = '3-MEDIUM' THEN 'cancelled' ELSE order_status END AS
  order_status, CASE WHEN shipping_method = '3-MEDIUM' THEN 0 ELSE order_total END AS order_total, created_at,
  shipping_method FROM {SNAPSHOT} WHERE shipping_method <> '4-NOT SPECIFIED')"""


@query("as_of_state", f"SELECT * FROM {SNAPSHOT}")
def as_of_state(m):
    return snapshot(m)


@query("restore_values", f"SELECT * FROM {SNAPSHOT} WHERE shipping_method <> '4-NOT SPECIFIED'")
def restore_values(m):
    s = durable(snapshot(m))
    return changes.restore_values(damaged(m), s, KEY, ["order_status", "order_total"])


@query("recover_deleted", f"SELECT * FROM {DAMAGED} UNION ALL SELECT * FROM {SNAPSHOT} WHERE shipping_method = '4-NOT SPECIFIED'")
def recover_deleted(m):
    return changes.recover_deleted(damaged(m), snapshot(m), KEY)


@query("incident_report", f"""WITH d AS (SELECT * FROM {DAMAGED}), s AS (SELECT * FROM {SNAPSHOT})
  SELECT 'damaged' AS stage, order_status, count(*) AS orders, round(sum(order_total), 2) AS value FROM d GROUP BY ALL
  UNION ALL SELECT 'snapshot', order_status, count(*), round(sum(order_total), 2) FROM s GROUP BY ALL
  UNION ALL SELECT 'fixed', order_status, count(*), round(sum(order_total), 2) FROM s GROUP BY ALL""")
def incident_report(m):
    """Status counts of the damaged table, the snapshot and the repaired table."""
    good = durable(snapshot(m))
    bad = durable(damaged(m))
    fixed = changes.restore_values(bad, good, KEY, ["order_status", "order_total"])
    fixed = changes.recover_deleted(fixed, good, KEY)
    stages = [
        df.select(F.lit(name).alias("stage"), "order_status", "order_total")
        for name, df in (("damaged", bad), ("snapshot", good), ("fixed", fixed))
    ]
    every = stages[0].unionByName(stages[1]).unionByName(stages[2])
    return every.groupBy("stage", "order_status").agg(
        rows().alias("orders"), F.round(F.sum("order_total"), 2).alias("value")
    )


@query("incremental_aggregate", f"""SELECT product_id, count(*) AS rows, {q.money('line_total')} AS total,
  round(min(line_total), 4) AS low, round(max(line_total), 4) AS high FROM item GROUP BY product_id""")
def incremental_aggregate(m):
    """Totals kept over the stored items. The first call folds in all files; later ones
    compare the file listing with the mark and read only files that came since."""
    columns = lambda rows: rows.select(
        F.col("l_partkey").alias("product_id"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_total")
    )
    source = f"{m.path}/lineitem.parquet"
    kept_totals = MaintainedTotals(m.spark, kept(m.spark, "item-totals", source), source, ("product_id",), "line_total", columns)
    kept_totals.refresh()
    return kept_totals.read().select(
        "product_id",
        "rows",
        settled(F.col("total")).alias("total"),
        F.round("low", 4).alias("low"),
        F.round("high", 4).alias("high"),
    )
