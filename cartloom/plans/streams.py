"""Streaming queries: each writes arriving files from the stored tables, runs the
stream on them and returns what the stream left behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import rows
from cartloom.operators import changes
from cartloom.operators.buckets import BucketTable
from cartloom.operators.groups import Order
from cartloom.plans.changes import COLS, KEY, V2, misspelt, order_rules, version_two
from cartloom.plans.registry import query
from cartloom.session import durable, scratch
from cartloom.streaming import alerts, cdc, ingest


def paths(m, *labels):
    return [scratch(m.spark, x) for x in labels]


@query("stream_file_ingest", f"SELECT {COLS} FROM ord")
def stream_file_ingest(m):
    """Two rounds over a growing folder; each file is taken once."""
    inbox, table, mark = paths(m, "inbox", "ingested", "mark")
    for status in ("delivered", "shipped", "placed"):
        m.orders(status).write.mode("append").parquet(inbox)
        stream = ingest.arriving(m.spark, inbox, m.orders().schema, pattern="*.parquet")
        ingest.append_to(stream, table, mark)
    return m.spark.read.schema(m.orders().schema).parquet(table)


@query("ingest_lag", """SELECT CASE WHEN order_status = 'placed' THEN 'pending' ELSE 'loaded' END AS state,
  CAST(sum(CASE WHEN order_status = 'placed' THEN 0 ELSE 1 END) AS BIGINT) AS rows FROM ord GROUP BY 1""")
def ingest_lag(m):
    """Some files arrive after the last run and are reported as pending."""
    inbox, table, mark = paths(m, "inbox", "ingested", "mark")
    m.orders("delivered", "shipped").write.mode("append").parquet(inbox)
    stream = ingest.arriving(m.spark, inbox, m.orders().schema)
    ingest.append_to(ingest.with_source_file(stream), table, mark)
    m.orders("placed").write.mode("append").parquet(inbox)
    return ingest.lag(m.spark, inbox, m.spark.read.parquet(table), pattern="*.parquet").select("state", "rows")


@query("stream_cdc_merge", f"SELECT * FROM {V2}")
def stream_cdc_merge(m):
    """A first version of the orders in key buckets, then a feed in two files, the later
    one repeating part of the earlier; each batch rewrites the buckets that it touches."""
    path, feeds, mark = paths(m, "orders", "feed", "mark")
    orders = m.orders()
    size = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
    table = BucketTable(m.spark, path, orders.schema, tuple(KEY), buckets=size)
    table.create(orders)
    feed = durable(changes.change_feed(orders, version_two(m), KEY))
    numbered = lambda n: feed.withColumn("round", F.lit(n))
    order = [Order("round"), Order("is_update")]
    for n, part in ((1, numbered(1).filter(~F.col("is_update"))), (2, numbered(2))):
        part.write.mode("append").parquet(feeds)
        cdc.merge_buckets(ingest.arriving(m.spark, feeds, numbered(1).schema), table, mark, order)
    return table.read()


def live_orders(m):
    """A projection of arriving orders, kept as a table."""
    inbox, table, mark = paths(m, "inbox", "live", "mark")
    for status in ("delivered", "shipped", "placed"):
        m.orders(status).write.mode("append").parquet(inbox)
        stream = ingest.arriving(m.spark, inbox, m.orders().schema)
        ingest.append_to(stream.select("order_id", "order_status", "order_total"), table, mark)
    return table


@query("live_projection", "SELECT order_id, order_status, order_total FROM ord")
def live_projection(m):
    return m.spark.read.parquet(live_orders(m))


@query("live_aggregate", "SELECT order_status, count(*) AS orders FROM ord GROUP BY 1")
def live_aggregate(m):
    """Counts by status, chained to the live projection."""
    source = live_orders(m)
    target, mark = paths(m, "counts", "mark")
    stream = ingest.arriving(m.spark, source, "order_id bigint, order_status string, order_total double")
    ingest.snapshots(stream.groupBy("order_status").agg(rows().alias("orders")), target, mark)
    return ingest.current(m.spark, target)


@query("stream_dead_letter", """SELECT order_id, CASE WHEN order_status = 'placed' AND shipping_method = '5-LOW' THEN 'plced'
  ELSE order_status END AS order_status, CASE WHEN order_status = 'placed' AND shipping_method = '5-LOW' THEN
  'unrecognized order_status' END AS reason FROM ord""")
def stream_dead_letter(m):
    inbox, valid, rejected, mark = paths(m, "inbox", "valid", "rejected", "mark")
    m.orders().withColumn("order_status", misspelt()).write.parquet(inbox)
    cdc.split_stream(ingest.arriving(m.spark, inbox, m.orders().schema), order_rules(), valid, rejected, mark)
    good = m.spark.read.parquet(valid).select("order_id", "order_status", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(m.spark.read.parquet(rejected).select("order_id", "order_status", "reason"))


@query("stream_windowed_alert", """SELECT time_bucket(INTERVAL 2 MINUTE, created_at) AS slice_start,
  time_bucket(INTERVAL 2 MINUTE, created_at) + INTERVAL 2 MINUTE AS slice_end, count(*) AS rejected FROM click
  WHERE event_type = 'error' AND time_bucket(INTERVAL 2 MINUTE, created_at) + INTERVAL 2 MINUTE <=
  (SELECT max(created_at) FROM click WHERE event_type = 'error') - INTERVAL 10 MINUTE GROUP BY ALL""")
def stream_windowed_alert(m):
    """Slices that hold a rejected row, each reported once when it is closed: when a
    rejected row ten minutes younger has been seen."""
    inbox, fired, mark = paths(m, "inbox", "fired", "mark")
    c = m.clicks().select("created_at", "event_type")
    c.write.parquet(inbox)
    bad = ingest.arriving(m.spark, inbox, c.schema).filter(F.col("event_type") == "error")
    stream = alerts.stamped(bad, "created_at", "10 minutes")
    ingest.append_to(alerts.slices(stream, "created_at", "2 minutes"), fired, mark)
    return m.spark.read.parquet(fired)


@query("stream_alert_spells", """WITH bad AS (SELECT device, created_at FROM click WHERE event_type = 'error'), mark AS (SELECT
  max(created_at) - INTERVAL 10 MINUTE AS w FROM bad), closed AS (SELECT device, created_at, created_at - lag(created_at) OVER (PARTITION
  BY device ORDER BY created_at) > INTERVAL 2 MINUTE AS cut FROM bad, mark WHERE time_bucket(INTERVAL 2 MINUTE, created_at) +
  INTERVAL 2 MINUTE <= w), numbered AS (SELECT device, created_at, count(*) FILTER (WHERE cut) OVER (PARTITION BY device ORDER BY
  created_at) AS n FROM closed), spell AS (SELECT device, n, min(created_at) AS started, max(created_at) AS seen, count(*) AS rejected,
  lead(n) OVER (PARTITION BY device ORDER BY n) IS NOT NULL AS followed FROM numbered GROUP BY device, n)
  SELECT device, 'fired' AS state, started AS at, CAST(NULL AS BIGINT) AS rejected FROM spell UNION ALL
  SELECT device, 'cleared', seen + INTERVAL 2 MINUTE, rejected FROM spell, mark WHERE followed OR seen + INTERVAL 4 MINUTE < w""")
def stream_alert_spells(m):
    """Per device: an alert fires once when error events begin and is cleared two minutes
    after the last one. The stream is let go on in two runs over a growing folder."""
    inbox, fired, mark = paths(m, "inbox", "spells", "mark")
    c = m.clicks().select("created_at", "event_type", "device")
    middle = c.agg(F.expr("timestampadd(MICROSECOND, timestampdiff(MICROSECOND, min(created_at), max(created_at)) div 2, min(created_at))")).scalar()
    for part in (c.filter(F.col("created_at") < middle), c.filter(F.col("created_at") >= middle)):
        part.write.mode("append").parquet(inbox)
        bad = ingest.arriving(m.spark, inbox, c.schema).filter(F.col("event_type") == "error")
        stream = alerts.spells(alerts.stamped(bad, "created_at", "10 minutes"), "created_at", 120, ["device"])
        with alerts.state_store(m.spark):
            ingest.append_to(stream, fired, mark)
    return m.spark.read.parquet(fired).withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("refresh_parity", """SELECT (SELECT count(*) FROM ord) AS rows_recomputed,
  (SELECT count(*) FROM ord) AS rows_merged, (SELECT count(*) FROM ord) AS rows_streamed, CAST(0 AS BIGINT) AS differences""")
def refresh_parity(m):
    """One mart three ways: recomputed, merged from a feed, streamed."""
    full = m.orders().select(*KEY, "customer_id", "order_total")
    start = full.filter(F.col("order_total") < 250000)
    merged = changes.apply_changes(start, changes.change_feed(start, full, KEY), KEY)
    inbox, table, mark = paths(m, "inbox", "mart", "mark")
    for part in (start, full.filter(F.col("order_total") >= 250000)):
        part.write.mode("append").parquet(inbox)
        ingest.append_to(ingest.arriving(m.spark, inbox, full.schema), table, mark)
    streamed = m.spark.read.schema(full.schema).parquet(table)
    apart = None
    for other in (merged, streamed):
        diff = full.exceptAll(other).unionAll(other.exceptAll(full))
        apart = diff if apart is None else apart.unionAll(diff)
    return full.agg(rows().alias("rows_recomputed")).withColumns(
        {
            "rows_merged": merged.agg(rows()).scalar(),
            "rows_streamed": streamed.agg(rows()).scalar(),
            "differences": apart.agg(rows()).scalar(),
        }
    )
