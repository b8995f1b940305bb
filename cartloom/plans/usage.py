"""Usage and cost analysis, and alerts over logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import money, rows, total_of
from cartloom.operators import metering
from cartloom.plans import oracle as q
from cartloom.plans.registry import query

MONTH_TO_DATE = "start_time >= (SELECT date_trunc('month', max(start_time)) FROM meter)"


def month_to_date(u):
    """Rows since the start of the month of the last row."""
    start = u.agg(F.date_trunc("month", F.max("start_time")).cast("timestamp_ntz")).scalar()
    return u.filter(F.col("start_time") >= start)


@query("usage_daily", f"""WITH d AS (SELECT CAST(start_time AS DATE) AS day, resource, {q.money('credits')} AS credits
  FROM meter GROUP BY ALL) SELECT day, resource, credits, day = arg_max(day, (credits, -date_diff('day', DATE '2000-01-01', day)))
  OVER (PARTITION BY resource) AS is_spike FROM d""")
def usage_daily(m):
    """Credits per day; the spike is a resource's highest day, the earliest of equals."""
    day = F.col("start_time").cast("date")
    d = m.usage().groupBy(day.alias("day"), "resource").agg(money("credits").alias("credits"))
    height = F.struct("credits", -F.datediff("day", F.lit("2000-01-01").cast("date")))
    spikes = d.groupBy("resource").agg(F.max_by("day", height).alias("spike_day"))
    return d.join(spikes, "resource").select("day", "resource", "credits", (F.col("day") == F.col("spike_day")).alias("is_spike"))


@query("usage_summary", f"""SELECT resource, {q.money('credits')} AS credits, count(*) AS actions,
  count(DISTINCT date_trunc('hour', start_time)) AS billed_hours FROM meter WHERE {MONTH_TO_DATE} GROUP BY resource""")
def usage_summary(m):
    """Hours are counted after grouping by hour, so each hour is one row."""
    hours = month_to_date(m.usage()).groupBy("resource", F.date_trunc("hour", "start_time").alias("hour")).agg(
        F.sum("credits").alias("c"), rows().alias("n")
    )
    return hours.groupBy("resource").agg(
        total_of("c").alias("credits"), F.sum("n").alias("actions"), rows().alias("billed_hours")
    )


@query("usage_by_service", f"""SELECT service, coalesce({q.money('credits')}, 0) AS credits, count(resource) AS actions,
  coalesce({q.money("CASE WHEN resource <> 'error' THEN credits END")}, 0) AS credits_without_errors
  FROM (SELECT DISTINCT resource AS service FROM meter UNION ALL SELECT 'archive') LEFT JOIN meter ON service = resource
  GROUP BY service""")
def usage_by_service(m):
    """A service nobody used reports zero and does not vanish."""
    per = m.usage().groupBy("resource").agg(money("credits").alias("credits"), rows().alias("actions"))
    none = m.spark.range(1).select(
        F.lit("archive").alias("resource"), F.lit(0.0).alias("credits"), F.lit(0).cast("bigint").alias("actions")
    )
    services = per.unionByName(none).groupBy(F.col("resource").alias("service"))
    both = services.agg(F.sum("credits").alias("credits"), F.sum("actions").alias("actions"))
    return both.withColumn(
        "credits_without_errors", F.when(F.col("service") == "error", 0.0).otherwise(F.col("credits"))
    )


@query("storage_trend", """SELECT CAST(shipped_at AS DATE) AS day, return_flag AS area,
  CAST(round(CAST(sum(quantity) * 1048576 / power(1024, 3) AS DECIMAL(38,8)), 4) AS DOUBLE) AS gb,
  CAST(round(CAST(sum(CASE WHEN line_status = 'F' THEN quantity ELSE 0 END) / nullif(sum(CASE WHEN line_status = 'O' THEN quantity
  ELSE 0 END), 0) AS DECIMAL(38,8)), 4) AS DOUBLE) AS overhead FROM item GROUP BY ALL""")
def storage_trend(m):
    """Stored volume per day and area (a mebibyte per unit), and retained against
    active volume; NULL where nothing is active."""
    units = lambda status: F.sum(F.when(F.col("line_status") == status, F.col("quantity")).otherwise(0.0))
    r4 = lambda x: F.round(x.cast("decimal(38,8)"), 4).cast("double")
    i = m.items().select("shipped_at", "return_flag", "line_status", "quantity")
    return i.groupBy(F.col("shipped_at").cast("date").alias("day"), F.col("return_flag").alias("area")).agg(
        r4(F.sum("quantity") * 1048576 / F.pow(F.lit(1024.0), F.lit(3.0))).alias("gb"),
        r4(units("F") / F.nullif(units("O"), F.lit(0.0))).alias("overhead"),
    )


def query_log(m):
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    return m.usage().select(
        "query_id", "query_tag", "resource", "start_time", (k * 10).alias("execution_ms"), (k * 1000).alias("bytes_scanned")
    )


def attribution(m):
    """Cost rows: failed queries are not attributed."""
    return m.usage().filter(F.col("resource") != "error").select("query_id", "credits")


LOG = """(SELECT query_id, query_tag, resource, start_time, 10 * CAST(json_extract(props, '$.k') AS BIGINT) AS execution_ms,
  1000 * CAST(json_extract(props, '$.k') AS BIGINT) AS bytes_scanned FROM meter)"""
COST = "(SELECT query_id, credits FROM meter WHERE resource <> 'error')"


@query("query_attribution", f"""SELECT query_id, resource, execution_ms, bytes_scanned, credits FROM {LOG} JOIN {COST}
  USING (query_id) ORDER BY credits DESC, query_id LIMIT 20""")
def query_attribution(m):
    log = query_log(m).drop("query_tag", "start_time")
    return log.join(attribution(m), "query_id").orderBy(F.desc("credits"), "query_id").limit(20)


@query("tag_cost", f"""SELECT query_tag, count(*) AS queries, count(credits) AS attributed, coalesce({q.money('credits')}, 0) AS
  credits FROM {LOG} LEFT JOIN {COST} USING (query_id) GROUP BY query_tag""")
def tag_cost(m):
    both = query_log(m).select("query_id", "query_tag").join(attribution(m), "query_id", "left")
    return both.groupBy("query_tag").agg(
        rows().alias("queries"),
        F.count("credits").alias("attributed"),
        F.coalesce(money("credits"), F.lit(0.0)).alias("credits"),
    )


@query("idle_cost", f"""SELECT day, resource, metered, attributed, round(coalesce(metered, 0) - coalesce(attributed, 0), 2)
  AS idle FROM (SELECT CAST(start_time AS DATE) AS day, resource, {q.money('credits')} AS metered FROM meter GROUP BY ALL)
  FULL JOIN (SELECT CAST(start_time AS DATE) AS day, resource, {q.money('credits')} AS attributed FROM meter
  WHERE credits > 20 AND resource <> 'view' GROUP BY ALL) USING (day, resource)""")
def idle_cost(m):
    key = [F.col("start_time").cast("date").alias("day"), "resource"]
    metered = m.usage().groupBy(*key).agg(money("credits").alias("metered"))
    used = m.usage().filter((F.col("credits") > 20) & (F.col("resource") != "view"))
    used = used.groupBy(*key).agg(money("credits").alias("attributed"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    both = metered.join(used, ["day", "resource"], "full")
    return both.withColumn("idle", F.round(zero("metered") - zero("attributed"), 2))


QUOTA = 15000.0
PERCENTS = [50, 75, 90, 100]


@query("quota_crossings", f"""WITH r AS (SELECT CAST(start_time AS DATE) AS day, start_time, round(sum(credits) OVER (PARTITION BY
  CAST(start_time AS DATE) ORDER BY start_time, query_id ROWS UNBOUNDED PRECEDING), 2) AS used FROM meter)
  SELECT day, CAST(pct AS BIGINT) AS pct, min(start_time) AS crossed_at FROM r, (SELECT unnest({PERCENTS}) AS pct)
  WHERE used >= CAST({QUOTA} * pct / 100 AS DOUBLE) GROUP BY ALL""")
def quota_crossings(m):
    return metering.quota_crossings(m.usage(), "start_time", "query_id", "credits", QUOTA, PERCENTS)


IDLE = 1200
SIZES = {"click": 0, "view": 1, "purchase": 2, "signup": 3, "error": 4}


@query("billed_seconds", f"""WITH g AS (SELECT resource, start_time, query_id, CASE WHEN lag(start_time) OVER w IS NULL OR
  epoch_us(start_time) - epoch_us(lag(start_time) OVER w) > {IDLE} * 1000000 THEN 1 ELSE 0 END AS s FROM meter
  WINDOW w AS (PARTITION BY resource ORDER BY start_time, query_id)), n AS (SELECT *, CAST(sum(s) OVER (PARTITION BY resource
  ORDER BY start_time, query_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM g),
  b AS (SELECT resource, session_no, min(start_time) AS started_at, max(start_time) AS ended_at, count(*) AS actions,
  greatest(CAST(ceil((epoch_us(max(start_time)) - epoch_us(min(start_time))) / 1e6) AS BIGINT), 60) AS billed_seconds
  FROM n GROUP BY ALL) SELECT *, round(billed_seconds * power(2e0, CASE resource WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN
  'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) / 3600, 6) AS credits FROM b""")
def billed_seconds(m):
    size = F.lit(None).cast("double")
    for name, step in SIZES.items():
        size = F.when(F.col("resource") == name, float(step)).otherwise(size)
    s = metering.sessions(m.usage(), "resource", "start_time", "query_id", IDLE)
    return metering.billed(s, size)


@query("slow_query_log", f"""SELECT query_id, query_tag, resource, execution_ms, bytes_scanned, start_time FROM {LOG}
  WHERE start_time >= (SELECT CAST(max(start_time) AS DATE) FROM meter) - INTERVAL 7 DAY AND resource NOT ILIKE '%SIGN%'
  ORDER BY execution_ms DESC, bytes_scanned DESC, query_id LIMIT 20""")
def slow_query_log(m):
    """Recent slow queries; the log's own queries are left out by their text."""
    log = query_log(m)
    since = log.agg(F.date_sub(F.max("start_time").cast("date"), 7).cast("timestamp_ntz")).scalar()
    recent = log.filter((F.col("start_time") >= since) & ~F.col("resource").ilike("%SIGN%"))
    return recent.orderBy(F.desc("execution_ms"), F.desc("bytes_scanned"), "query_id").limit(20)


# --- alerts --------------------------------------------------------------------------


@query("windowed_alert", """SELECT time_bucket(INTERVAL 2 MINUTE, created_at) AS slice_start,
  time_bucket(INTERVAL 2 MINUTE, created_at) + INTERVAL 2 MINUTE AS slice_end, count(*) AS rejected
  FROM click WHERE event_type = 'error' OR customer_id IS NULL GROUP BY ALL""")
def windowed_alert(m):
    """A slice of two minutes fires when it holds a rejected row."""
    bad = m.clicks().filter((F.col("event_type") == "error") | F.col("customer_id").isNull())
    return metering.tumbling(bad, "created_at", "2 minutes", [], rows().alias("rejected"))


@query("threshold_alert", f"""SELECT time_bucket(INTERVAL 6 HOUR, start_time) AS slice_start, time_bucket(INTERVAL 6 HOUR,
  start_time) + INTERVAL 6 HOUR AS slice_end, resource, {q.money('credits')} AS credits FROM meter GROUP BY ALL
  HAVING round(sum(credits), 4) > 700""")
def threshold_alert(m):
    t = metering.tumbling(m.usage(), "start_time", "6 hours", ["resource"], F.sum("credits").alias("_c"))
    over = t.filter(F.round("_c", 4) > 700)
    return over.withColumn("credits", F.round(F.round("_c", 4).cast("decimal(38,4)"), 2).cast("double")).drop("_c")
