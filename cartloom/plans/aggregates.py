"""Aggregation and multi-step queries.

Exact distinct counts of a hot group are safe as they stand: Spark groups by
(group, value) first, which spreads the group over its values.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from cartloom.functions.scalar import mean, money, month, pct, r2, rows, total_of
from cartloom.functions.udfs import custom_aggregate
from cartloom.operators import quality
from cartloom.operators.borders import tiles_of_all
from cartloom.operators.distinct import distinct_counts, merged, sketches
from cartloom.operators.groups import Order, attach, ranked
from cartloom.operators.hierarchy import walk
from cartloom.plans import oracle as q
from cartloom.plans.joins import per_order_totals, supplier_ratings, ts
from cartloom.plans.registry import query
from cartloom.session import durable


@query("count_variants", """SELECT count(*) AS events, count(customer_id) AS identified,
  count(*) - count(customer_id) AS anonymous, count(DISTINCT customer_id) AS people FROM click""")
def count_variants(m):
    return m.clicks().agg(
        rows().alias("events"),
        F.count("customer_id").alias("identified"),
        (rows() - F.count("customer_id")).alias("anonymous"),
        F.count_distinct("customer_id").alias("people"),
    )


@query("count_distinct_multi", """SELECT count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products,
  count(DISTINCT supplier_id) AS suppliers, count(DISTINCT shipped_at) AS days FROM item""")
def count_distinct_multi(m):
    names = {"orders": "order_id", "products": "product_id", "suppliers": "supplier_id", "days": "shipped_at"}
    # generated ids fill their range; days do not
    return distinct_counts(m.items(deal=False), names, dense=["order_id", "product_id", "supplier_id"])


@query("approx_distinct")
def approx_distinct(m):
    """A sketch of one percent error; no key is shuffled."""
    return m.items().agg(F.approx_count_distinct("order_id", 0.01).alias("approx_orders"))


@query("distinct_sketches", """SELECT CAST(year(shipped_at) AS BIGINT) AS ship_year, count(DISTINCT order_id) AS orders,
  true AS estimate_within_5_pct FROM item GROUP BY ALL""")
def distinct_sketches(m):
    """Sketches per shipping day are stored; a year's estimate is merged from its days
    alone and held against the exact count."""
    i = m.items(deal=False).select("order_id", F.to_date("shipped_at").alias("day"), F.year("shipped_at").cast("bigint").alias("ship_year"))
    stored = durable(sketches(i, "day", "order_id"))
    about = merged(stored.withColumn("ship_year", F.year("day").cast("bigint")), "ship_year")
    exact = distinct_counts(i, {"orders": "order_id"}, dense=["order_id"], by=["ship_year"])
    both = exact.join(about, exact.ship_year.eqNullSafe(about.ship_year))
    return both.select(exact.ship_year, "orders", (F.abs(F.col("estimate") - F.col("orders")) <= 0.05 * F.col("orders")).alias("estimate_within_5_pct"))


@query("conditional_agg", f"""SELECT count(*) AS orders, count(*) FILTER (order_total >= 400000) AS high,
  count(*) FILTER (order_total >= 100000 AND order_total < 400000) AS middle,
  count(*) FILTER (order_total < 100000) AS low, {q.mean('order_total')} AS avg_total
  FROM ord WHERE order_status = 'delivered'""")
def conditional_agg(m):
    t = F.col("order_total")
    return m.orders("delivered").agg(
        rows().alias("orders"),
        F.count_if(t >= 400000).alias("high"),
        F.count_if((t >= 100000) & (t < 400000)).alias("middle"),
        F.count_if(t < 100000).alias("low"),
        mean("order_total").alias("avg_total"),
    )


@query("monthly_revenue", f"""WITH per_order AS (SELECT order_id, sum(line_total) AS total FROM item GROUP BY order_id)
  SELECT {q.month('created_at')} AS order_month, count(DISTINCT customer_id) AS customers, count(*) AS orders,
  {q.money('total')} AS revenue, {q.mean('order_total')} AS avg_order FROM ord JOIN per_order USING (order_id)
  WHERE order_status = 'delivered' GROUP BY 1""")
def monthly_revenue(m):
    """Items are summed per order before the join, so orders are counted without a
    distinct and the order average is over orders, not over items."""
    o = m.orders("delivered").join(per_order_totals(m), "order_id")
    return o.groupBy(month("created_at").alias("order_month")).agg(
        F.count_distinct("customer_id").alias("customers"),
        rows().alias("orders"),
        total_of("total").alias("revenue"),
        mean("order_total").alias("avg_order"),
    )


@query("category_summary", f"""SELECT category, count(DISTINCT order_id) AS orders, count(*) AS items,
  CAST(sum(quantity) AS BIGINT) AS units, {q.money('line_total')} AS revenue, {q.mean('line_total')} AS avg_line,
  min(gross) AS min_gross, max(gross) AS max_gross FROM item JOIN prod USING (product_id) JOIN ord USING (order_id)
  WHERE order_status = 'delivered' GROUP BY category""")
def category_summary(m):
    lines = (
        m.items()
        .select("order_id", "product_id", "quantity", "gross", "line_total")
        .join(m.products().select("product_id", "category"), "product_id")
        .join(m.orders("delivered").select("order_id"), "order_id")
    )
    return lines.groupBy("category").agg(
        F.count_distinct("order_id").alias("orders"),
        rows().alias("items"),
        F.sum("quantity").cast("bigint").alias("units"),
        money("line_total").alias("revenue"),
        mean("line_total").alias("avg_line"),
        F.min("gross").alias("min_gross"),
        F.max("gross").alias("max_gross"),
    )


@query("having_filter", f"""SELECT customer_id, segment, country, count(DISTINCT order_id) AS orders,
  {q.money('line_total')} AS spent FROM cust JOIN ord USING (customer_id) JOIN item USING (order_id)
  WHERE order_status = 'delivered' GROUP BY ALL HAVING sum(line_total) > 400000""")
def having_filter(m):
    spent = (
        m.orders("delivered").select("order_id", "customer_id").join(per_order_totals(m), "order_id")
        .groupBy("customer_id").agg(rows().alias("orders"), F.sum("total").alias("exact"), total_of("total").alias("spent"))
        .filter(F.col("exact") > 400000).drop("exact")
    )
    return spent.join(m.customers().select("customer_id", "segment", "country"), "customer_id")


@query("find_duplicates", """SELECT 'product name' AS found_on, product_name AS k, CAST(NULL AS BIGINT) AS k2,
  count(*) AS occurrences FROM prod GROUP BY product_name HAVING count(*) > 1 UNION ALL
  SELECT 'order line', CAST(order_id AS VARCHAR), CAST(line_no AS BIGINT), count(*) FROM item
  GROUP BY order_id, line_no HAVING count(*) > 1""")
def find_duplicates(m):
    def repeated(df, label, k, k2):
        n = df.groupBy(k.alias("k"), k2.alias("k2")).agg(rows().alias("occurrences"))
        return n.filter(F.col("occurrences") > 1).select(
            F.lit(label).alias("found_on"), F.col("k").cast("string").alias("k"), F.col("k2").cast("bigint").alias("k2"), "occurrences"
        )

    names = repeated(m.products(), "product name", F.col("product_name"), F.lit(None).cast("bigint"))
    return names.unionByName(repeated(m.items(), "order line", F.col("order_id"), F.col("line_no")))


@query("inline_view", f"""SELECT * FROM (SELECT customer_id, count(*) AS orders, {q.money('order_total')} AS spent
  FROM ord WHERE order_status = 'delivered' GROUP BY customer_id) WHERE spent > 500000 AND orders > 2""")
def inline_view(m):
    summary = customer_totals(m)
    return summary.filter((F.col("spent") > 500000) & (F.col("orders") > 2))


def customer_totals(m):
    o = m.orders("delivered").groupBy("customer_id")
    return o.agg(rows().alias("orders"), money("order_total").alias("spent"))


@query("scalar_subquery", f"""SELECT product_id, product_name, unit_price, avg_price,
  round(unit_price - avg_price, 2) AS above_avg FROM prod, (SELECT {q.mean('unit_price')} AS avg_price FROM prod)""")
def scalar_subquery(m):
    p = m.products().select("product_id", "product_name", "unit_price")
    average = p.agg(mean("unit_price")).scalar()
    return p.withColumn("avg_price", average).withColumn(
        "above_avg", F.round(F.col("unit_price") - F.col("avg_price"), 2)
    )


@query("decorrelated_avg", f"""SELECT order_id, customer_id, order_total, customer_avg,
  round(order_total - customer_avg, 2) AS above FROM ord JOIN (SELECT customer_id, {q.mean('order_total')} AS customer_avg
  FROM ord WHERE order_status = 'delivered' GROUP BY customer_id) USING (customer_id)
  WHERE order_status = 'delivered' AND order_total > customer_avg * 1.5e0""")
def decorrelated_avg(m):
    o = m.orders("delivered").select("order_id", "customer_id", "order_total")
    averages = o.groupBy("customer_id").agg(mean("order_total").alias("customer_avg"), rows().alias("_n"))
    both = attach(o, averages, ["customer_id"], "_n", ["order_id"]).drop("_n")
    above = both.filter(F.col("order_total") > F.col("customer_avg") * 1.5)
    return above.withColumn("above", F.round(F.col("order_total") - F.col("customer_avg"), 2))


@query("revenue_year_region", f"""SELECT year(created_at) AS y, region, count(*) AS orders,
  {q.money('order_total')} AS revenue FROM ord JOIN cust USING (customer_id) WHERE order_status = 'delivered' GROUP BY ALL""")
def revenue_year_region(m):
    o = m.orders("delivered").join(m.customers().select("customer_id", "region"), "customer_id")
    return o.groupBy(F.year("created_at").cast("bigint").alias("y"), "region").agg(
        rows().alias("orders"), money("order_total").alias("revenue")
    )


@query("top_products", f"""SELECT product_id, product_name, category, sold, revenue FROM (SELECT product_id,
  CAST(sum(quantity) AS BIGINT) AS sold, {q.money('line_total')} AS revenue FROM item GROUP BY product_id)
  JOIN prod USING (product_id) ORDER BY revenue DESC, product_id LIMIT 10""")
def top_products(m):
    sold = m.items(deal=False).groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("sold"), money("line_total").alias("revenue")
    )
    best = sold.orderBy(F.desc("revenue"), "product_id").limit(10)
    return best.join(m.products().select("product_id", "product_name", "category"), "product_id")


@query("return_rate", f"""SELECT category, count(*) AS items, count(*) FILTER (return_flag = 'R') AS refunds,
  {q.r2("100e0 * count(*) FILTER (return_flag = 'R') / nullif(count(*), 0)")} AS refund_pct,
  {q.r2("CAST(0.9 AS DOUBLE) * round(sum(line_total) FILTER (return_flag = 'R'), 4) / nullif(count(*) FILTER (return_flag = 'R'), 0)")}
  AS avg_refund FROM item JOIN prod USING (product_id) GROUP BY category HAVING count(*) >= 100""")
def return_rate(m):
    back = F.col("return_flag") == "R"
    lines = m.items().select("product_id", "line_total", "return_flag").join(
        m.products().select("product_id", "category"), "product_id"
    )
    g = lines.groupBy("category").agg(
        rows().alias("items"),
        F.count_if(back).alias("refunds"),
        F.sum(F.when(back, F.col("line_total"))).alias("_back"),
    )
    g = g.filter(F.col("items") >= 100)
    refunds = F.col("refunds")
    return g.withColumns(
        {
            "refund_pct": pct(refunds, F.col("items")),
            "avg_refund": r2(0.9 * F.round("_back", 4) / F.nullif(refunds, F.lit(0))),
        }
    ).drop("_back")


@query("status_share", f"""SELECT order_status, count(*) AS orders,
  {q.r2('100e0 * count(*) / sum(count(*)) OVER ()')} AS share_pct FROM ord GROUP BY order_status""")
def status_share(m):
    o = m.orders()
    whole = o.agg(rows()).scalar()
    g = o.groupBy("order_status").agg(rows().alias("orders"))
    return g.withColumn("share_pct", pct(F.col("orders"), whole))


@query("month_tiers", f"""SELECT *, CASE WHEN revenue >= 16500000 THEN 'strong' WHEN revenue >= 15000000 THEN 'normal'
  ELSE 'weak' END AS tier FROM (SELECT year(created_at) AS y, month(created_at) AS mo, count(*) AS orders,
  {q.money('order_total')} AS revenue, {q.mean('order_total')} AS avg_order FROM ord WHERE order_status = 'delivered'
  GROUP BY ALL)""")
def month_tiers(m):
    at = F.col("created_at")
    g = m.orders("delivered").groupBy(F.year(at).cast("bigint").alias("y"), F.month(at).cast("bigint").alias("mo"))
    g = g.agg(rows().alias("orders"), money("order_total").alias("revenue"), mean("order_total").alias("avg_order"))
    r = F.col("revenue")
    return g.withColumn("tier", F.when(r >= 16500000, "strong").when(r >= 15000000, "normal").otherwise("weak"))


@query("anonymous_rate", f"""SELECT device, count(*) AS events, count(*) - count(customer_id) AS anonymous,
  {q.r2('100e0 * (count(*) - count(customer_id)) / count(*)')} AS anonymous_pct FROM click GROUP BY device""")
def anonymous_rate(m):
    g = m.clicks().groupBy("device").agg(
        rows().alias("events"), (rows() - F.count("customer_id")).alias("anonymous")
    )
    return g.withColumn("anonymous_pct", pct(F.col("anonymous"), F.col("events")))


@query("cohort_new_returning", f"""WITH f AS (SELECT customer_id, {q.month('min(created_at)')} AS first_month FROM ord
  GROUP BY customer_id), t AS (SELECT {q.month('created_at')} AS order_month, o.customer_id, order_total,
  {q.month('created_at')} = first_month AS is_new FROM ord o JOIN f ON o.customer_id = f.customer_id)
  SELECT order_month, is_new, count(DISTINCT customer_id) AS customers, {q.money('order_total')} AS revenue
  FROM t GROUP BY ALL""")
def cohort_new_returning(m):
    """A customer's months are summed first; the first month is then the smallest
    of those few rows, so no order row is joined to a per-customer value."""
    per_month = m.orders().groupBy("customer_id", month("created_at").alias("order_month")).agg(
        F.sum("order_total").alias("total")
    )
    first = per_month.groupBy("customer_id").agg(F.min("order_month").alias("first_month"))
    tagged = per_month.join(first, "customer_id")
    return tagged.groupBy("order_month", (F.col("order_month") == F.col("first_month")).alias("is_new")).agg(
        rows().alias("customers"), total_of("total").alias("revenue")
    )


@query("rfm", f"""WITH g AS (SELECT customer_id, date_diff('day', CAST(max(created_at) AS DATE), (SELECT
  CAST(max(created_at) AS DATE) FROM ord)) AS recency, count(*) AS frequency, {q.money('order_total')} AS monetary FROM ord
  GROUP BY customer_id) SELECT *, ntile(5) OVER (ORDER BY recency, customer_id) AS r,
  ntile(5) OVER (ORDER BY frequency DESC, customer_id) AS f, ntile(5) OVER (ORDER BY monetary DESC, customer_id) AS mo,
  r + f + mo AS score FROM g""")
def rfm(m):
    """Recency counts from the last day in the data, so a rerun gives the same."""
    o = m.orders()
    last_day = o.agg(F.max(F.col("created_at").cast("date"))).scalar()
    g = o.groupBy("customer_id").agg(
        F.max(F.col("created_at").cast("date")).alias("_last"),
        rows().alias("frequency"),
        money("order_total").alias("monetary"),
    )
    g = g.withColumn("recency", F.datediff(last_day, F.col("_last")).cast("bigint")).drop("_last")
    # One row per customer, counted several times to find the borders: stored once.
    g, tie = durable(g), Order("customer_id")
    g = tiles_of_all(g, [Order("recency"), tie], 5, "r")
    g = tiles_of_all(g, [Order("frequency", True), tie], 5, "f")
    g = tiles_of_all(g, [Order("monetary", True), tie], 5, "mo")
    return g.withColumn("score", F.col("r") + F.col("f") + F.col("mo"))


@query("coefficient_of_variation", f"""SELECT category, count(*) AS months, {q.mean('revenue')} AS avg_revenue,
  CAST(round(CAST(stddev_samp(revenue) / avg(revenue) AS DECIMAL(38,8)), 4) AS DOUBLE) AS variation
  FROM (SELECT category, {q.month('shipped_at')} AS ship_month, {q.money('line_total')} AS revenue FROM item
  JOIN prod USING (product_id) GROUP BY ALL) GROUP BY category""")
def coefficient_of_variation(m):
    per_month = (
        m.items().select("product_id", "shipped_at", "line_total")
        .join(m.products().select("product_id", "category"), "product_id")
        .groupBy("category", month("shipped_at").alias("ship_month"))
        .agg(money("line_total").alias("revenue"))
    )
    ratio = F.stddev_samp("revenue") / F.avg("revenue")
    return per_month.groupBy("category").agg(
        rows().alias("months"),
        mean("revenue").alias("avg_revenue"),
        F.round(ratio.cast("decimal(38,8)"), 4).cast("double").alias("variation"),
    )


@query("event_funnel", """SELECT event_type, count(*) AS events, count(DISTINCT session_id) AS sessions,
  count(DISTINCT customer_id) AS people FROM click WHERE created_at >= TIMESTAMP '2024-01-05' GROUP BY event_type""")
def event_funnel(m):
    c = m.clicks().filter(F.col("created_at") >= ts("2024-01-05"))
    people = distinct_counts(c, {"sessions": "session_id", "people": "customer_id"}, dense=["customer_id"], by=["event_type"])
    events = c.groupBy("event_type").agg(rows().alias("events"))
    return events.join(people, events.event_type.eqNullSafe(people.event_type)).select(events.event_type, "events", "sessions", "people")


@query("pricing_summary", f"""SELECT return_flag, line_status, CAST(sum(quantity) AS BIGINT) AS units,
  {q.money('gross')} AS gross, {q.money('line_total')} AS net, {q.mean('quantity')} AS avg_units,
  {q.mean('gross')} AS avg_gross, count(*) AS items FROM item WHERE shipped_at <= TIMESTAMP '2001-06-02' GROUP BY ALL""")
def pricing_summary(m):
    i = m.items(deal=False).filter(F.col("shipped_at") <= ts("2001-06-02"))
    return i.groupBy("return_flag", "line_status").agg(
        F.sum("quantity").cast("bigint").alias("units"),
        money("gross").alias("gross"),
        money("line_total").alias("net"),
        mean("quantity").alias("avg_units"),
        mean("gross").alias("avg_gross"),
        rows().alias("items"),
    )


@query("customer_summary", f"""SELECT customer_id, customer_name, country, count(order_id) AS orders,
  coalesce({q.money('order_total')}, 0) AS lifetime_value FROM cust LEFT JOIN ord USING (customer_id) GROUP BY ALL""")
def customer_summary(m):
    per = m.orders().groupBy("customer_id").agg(rows().alias("orders"), money("order_total").alias("lifetime_value"))
    c = m.customers().select("customer_id", "customer_name", "country").join(per, "customer_id", "left")
    return c.fillna(0, ["orders", "lifetime_value"])


@query("customer_tiers", f"""WITH t AS (SELECT customer_id, count(*) AS orders, {q.money('order_total')} AS spent,
  min(created_at) AS first_at, max(created_at) AS last_at FROM ord WHERE order_status = 'delivered' GROUP BY customer_id)
  SELECT customer_name, country, segment, CASE WHEN spent >= 1200000 THEN 'platinum' WHEN spent >= 800000 THEN 'gold'
  WHEN spent >= 400000 THEN 'silver' ELSE 'bronze' END AS tier, orders, spent, date_diff('day', CAST(first_at AS DATE),
  CAST(last_at AS DATE)) AS lifespan_days FROM t JOIN cust USING (customer_id) WHERE spent >= 800000""")
def customer_tiers(m):
    return profile(m, tiered(spans(m))).filter(F.col("tier").isin("platinum", "gold"))


def spans(m):
    return m.orders("delivered").groupBy("customer_id").agg(
        rows().alias("orders"),
        money("order_total").alias("spent"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def tiered(df):
    s = F.col("spent")
    tier = F.when(s >= 1200000, "platinum").when(s >= 800000, "gold").when(s >= 400000, "silver")
    days = F.datediff("last_at", "first_at").cast("bigint")
    return df.withColumns({"tier": tier.otherwise("bronze"), "lifespan_days": days})


def profile(m, df):
    c = m.customers().select("customer_id", "customer_name", "country", "segment")
    return df.join(c, "customer_id").select(
        "customer_name", "country", "segment", "tier", "orders", "spent", "lifespan_days"
    )


DQ_SQL = """SELECT issue_type, count(*) AS issues, min(record_id) AS first_record FROM ({}) GROUP BY issue_type"""


@query("dq_report", DQ_SQL.format("""SELECT 'orphaned order' AS issue_type, order_id AS record_id FROM ord
  WHERE customer_id NOT IN (SELECT customer_id FROM cust WHERE is_active)
  UNION ALL SELECT 'orphaned item', order_id FROM item WHERE order_id NOT IN (SELECT order_id FROM ord
  WHERE order_status <> 'placed')
  UNION ALL SELECT 'orphaned return', order_id FROM ret WHERE order_id NOT IN (SELECT order_id FROM ord
  WHERE order_status = 'delivered') UNION ALL SELECT 'bad price', product_id FROM prod
  WHERE unit_price < 0 OR cost_price < 0 OR cost_price > unit_price * 0.6e0"""))
def dq_report(m):
    """Orders of closed accounts, items of orders not yet accepted, returns of
    undelivered orders and prices out of range; an empty result is clean data."""
    rec = F.col("order_id")
    price, cost = F.col("unit_price"), F.col("cost_price")
    bad_price = (price < 0) | (cost < 0) | (cost > price * 0.6)
    open_accounts = m.customers().filter("is_active")
    return quality.report(
        [
            quality.orphans(m.orders(), open_accounts, "customer_id", "orphaned order", rec),
            quality.orphans(m.items(), m.orders("delivered", "shipped"), "order_id", "orphaned item", rec),
            quality.orphans(m.returns(), m.orders("delivered"), "order_id", "orphaned return", rec),
            quality.violations(m.products(), bad_price, "bad price", F.col("product_id")),
        ]
    )


@query("dq_report_extra", DQ_SQL.format("""SELECT 'no order' AS issue_type, customer_id AS record_id FROM cust
  WHERE customer_id NOT IN (SELECT customer_id FROM ord)
  UNION ALL SELECT 'no review', product_id FROM prod WHERE product_id NOT IN (SELECT product_id FROM rev)
  UNION ALL SELECT 'shipped before order', i.order_id FROM item i JOIN ord o ON i.order_id = o.order_id
  WHERE shipped_at < created_at"""))
def dq_report_extra(m):
    early = m.items().select("order_id", "shipped_at").join(m.orders().select("order_id", "created_at"), "order_id")
    return quality.report(
        [
            quality.orphans(m.customers(), m.orders(), "customer_id", "no order", F.col("customer_id")),
            quality.orphans(m.products(), m.reviews(), "product_id", "no review", F.col("product_id")),
            quality.violations(
                early, F.col("shipped_at") < F.col("created_at"), "shipped before order", F.col("order_id")
            ),
        ]
    )


@query("supplier_scorecard", f"""WITH s AS (SELECT supplier_id, {q.money('line_total')} AS revenue,
  {q.r2("100e0 * count(*) FILTER (return_flag = 'R') / count(*)")} AS refund_pct FROM item GROUP BY supplier_id),
  v AS (SELECT supplier_id, {q.mean('rating')} AS avg_rating FROM rev JOIN prod USING (product_id) GROUP BY supplier_id),
  r AS (SELECT supplier_id, revenue, refund_pct, coalesce(avg_rating, 0) AS avg_rating,
  rank() OVER (ORDER BY revenue DESC) AS revenue_rank, rank() OVER (ORDER BY refund_pct) AS refund_rank,
  rank() OVER (ORDER BY coalesce(avg_rating, 0) DESC) AS rating_rank FROM s LEFT JOIN v USING (supplier_id))
  SELECT *, CAST(round(CAST((revenue_rank + refund_rank + rating_rank - 3) / (3e0 * ((SELECT count(*) FROM r) - 1))
  AS DECIMAL(38,8)), 4) AS DOUBLE) AS overall FROM r""")
def supplier_scorecard(m):
    """Mean of three percent ranks, 0 for the best."""
    sales = m.items().groupBy("supplier_id").agg(
        money("line_total").alias("revenue"), pct(F.count_if(F.col("return_flag") == "R"), rows()).alias("refund_pct")
    )
    s = sales.join(supplier_ratings(m), "supplier_id", "left").fillna(0.0, ["avg_rating"])
    s = durable(s)
    for by, out in ((Order("revenue", True), "revenue_rank"), (Order("refund_pct"), "refund_rank"), (Order("avg_rating", True), "rating_rank")):
        s = ranked(s, [], by, out, "_dense").drop("_dense")
    others = s.agg(rows() - 1).scalar()
    ranks = F.col("revenue_rank") + F.col("refund_rank") + F.col("rating_rank") - 3
    return s.withColumn("overall", F.round((ranks / (3.0 * others)).cast("decimal(38,8)"), 4).cast("double"))


@query("rated_products", f"""SELECT product_id, product_name, category, avg_rating, reviews FROM prod LEFT JOIN
  (SELECT product_id, {q.mean('rating')} AS avg_rating, count(*) AS reviews FROM rev GROUP BY product_id)
  USING (product_id) WHERE avg_rating >= 4""")
def rated_products(m):
    rated = m.reviews().groupBy("product_id").agg(mean("rating").alias("avg_rating"), rows().alias("reviews"))
    p = m.products().select("product_id", "product_name", "category")
    return p.join(rated, "product_id", "left").filter(F.col("avg_rating") >= 4)


@query("hierarchy_walk", """WITH RECURSIVE n AS (SELECT DISTINCT p_type AS id, CAST(NULL AS VARCHAR) AS up, p_type AS label
  FROM part UNION ALL SELECT DISTINCT p_type || '/' || p_brand, p_type, p_brand FROM part
  UNION ALL SELECT p_type || '/' || p_brand || '/' || p_partkey, p_type || '/' || p_brand, p_name || ' ' || p_partkey FROM part),
  t AS (SELECT id, label, CAST(0 AS BIGINT) AS depth, label AS path FROM n WHERE up IS NULL UNION ALL
  SELECT n.id, n.label, t.depth + 1, t.path || ' > ' || n.label FROM n JOIN t ON n.up = t.id)
  SELECT id, label, depth, path, repeat('  ', CAST(depth AS INTEGER)) || label AS indented FROM t""")
def hierarchy_walk(m):
    """The product tree: category, subcategory, product."""
    p = m.products()
    cat, sub, key = F.col("category"), F.col("subcategory"), F.col("product_id").cast("string")
    none = F.lit(None).cast("string")
    tree = (
        p.select(cat.alias("id"), none.alias("up"), cat.alias("label")).distinct()
        .unionByName(
            p.select(F.concat_ws("/", cat, sub).alias("id"), cat.alias("up"), sub.alias("label")).distinct()
        )
        .unionByName(
            p.select(
                F.concat_ws("/", cat, sub, key).alias("id"),
                F.concat_ws("/", cat, sub).alias("up"),
                F.concat_ws(" ", "product_name", key).alias("label"),
            )
        )
    )
    return walk(tree, "id", "up", "label")


@query("daily_and_status_counts", """WITH d AS (SELECT 'day' AS grouped_by, CAST(CAST(created_at AS DATE) AS VARCHAR) AS k,
  count(*) AS orders FROM ord GROUP BY ALL), s AS (SELECT 'status' AS grouped_by, order_status AS k, count(*) AS orders
  FROM ord GROUP BY ALL) SELECT * FROM d UNION ALL SELECT * FROM s UNION ALL SELECT 'summary',
  (SELECT count(*) FROM d) || ' days, ' || (SELECT count(*) FROM s) || ' statuses', (SELECT count(*) FROM ord)""")
def daily_and_status_counts(m):
    """Two independent results and the step that waits for both.  Days and statuses
    are read off one grouping of the orders."""
    cells = m.orders().groupBy(F.col("created_at").cast("date").alias("day"), "order_status").agg(rows().alias("n"))
    total = F.sum("n").alias("orders")
    days = cells.groupBy(F.lit("day").alias("grouped_by"), F.col("day").cast("string").alias("k")).agg(total)
    statuses = cells.groupBy(F.lit("status").alias("grouped_by"), F.col("order_status").alias("k")).agg(total)
    note = F.concat(
        F.count_distinct("day").cast("string"), F.lit(" days, "), F.count_distinct("order_status").cast("string"), F.lit(" statuses")
    )
    summary = cells.agg(F.lit("summary").alias("grouped_by"), note.alias("k"), total)
    return days.unionByName(statuses).unionByName(summary)


@query("status_counts_log", """SELECT order_status, count(*) AS orders, (SELECT max(created_at) FROM ord) AS logged_at
  FROM ord GROUP BY order_status""")
def status_counts_log(m):
    o = m.orders()
    counts = o.groupBy("order_status").agg(rows().alias("orders"), F.max("created_at").alias("_last"))
    logged = counts.agg(F.max("_last")).scalar()
    return counts.withColumn("logged_at", logged).drop("_last")


@query("udaf_weighted_mean", f"""SELECT supplier_id, count(*) AS items,
  CAST(round(CAST(sum(gross * quantity) / sum(quantity) AS DECIMAL(38,6)), 2) AS DOUBLE) AS weighted_gross
  FROM item GROUP BY supplier_id""")
def udaf_weighted_mean(m):
    """A user-defined aggregate: gross price weighted by quantity, per supplier."""

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(value=pdf.gross * pdf.quantity, weight=pdf.quantity, n=1)
        return pdf.groupby("supplier_id", as_index=False, dropna=False)[["value", "weight", "n"]].sum()

    value, weight = F.sum("value"), F.sum("weight")
    return custom_aggregate(
        m.items().select("supplier_id", "gross", "quantity"),
        ["supplier_id"],
        "value double, weight double, n bigint",
        partial,
        {"items": F.sum("n"), "weighted_gross": r2(value / F.nullif(weight, F.lit(0.0)))},
    )
