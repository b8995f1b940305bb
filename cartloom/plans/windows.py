"""Window functions.

Windows over stored rows go through ``operators.groups`` so that one key with a
large share of the rows is split over tasks.  Windows over the whole result run
only after an aggregation to a bounded number of rows (calendar months, weeks).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.functions.scalar import mean, money, month, r2, rows
from cartloom.operators.borders import tiles_of_all
from cartloom.operators.groups import (
    Neighbour,
    Order,
    Position,
    Running,
    attach,
    best_per_group,
    find_hot,
    in_order,
    newest,
    ranked,
)
from cartloom.plans import oracle as q
from cartloom.plans.registry import query
from cartloom.session import durable

BY_DATE = [Order("created_at"), Order("order_id")]


def calendar():
    """The months in order; used only on results of one row per month."""
    return Window.orderBy("order_month")


def month_revenue(m):
    """Delivered revenue per month: one row per calendar month."""
    o = m.orders("delivered").groupBy(month("created_at").alias("order_month"))
    return o.agg(money("order_total").alias("revenue"), rows().alias("orders"))


MONTHS = f"""(SELECT {q.month('created_at')} AS order_month, {q.money('order_total')} AS revenue, count(*) AS orders
  FROM ord WHERE order_status = 'delivered' GROUP BY 1)"""


@query("order_sequence", """SELECT customer_id, order_id, order_total, created_at, row_number() OVER (PARTITION BY
  customer_id ORDER BY created_at, order_id) AS order_no FROM ord""")
def order_sequence(m):
    o = m.orders().select("customer_id", "order_id", "order_total", "created_at")
    return in_order(o, ["customer_id"], BY_DATE, [Position("order_no")])


@query("latest_per_key", """SELECT customer_id, order_id, order_total, created_at FROM ord QUALIFY row_number() OVER
  (PARTITION BY customer_id ORDER BY created_at DESC, order_id DESC) = 1""")
def latest_per_key(m):
    return newest(m.orders().select("customer_id", "order_id", "order_total", "created_at"), ["customer_id"], BY_DATE)


def product_ratings(m):
    """Ratings per category and product name, names with enough reviews."""
    named = m.products().select("product_id", "category", "product_name")
    r = m.reviews().select("product_id", "rating").join(named, "product_id")
    r = r.groupBy("category", "product_name").agg(mean("rating").alias("avg_rating"), rows().alias("reviews"))
    return r.filter(F.col("reviews") >= 2)


RATINGS = f"""(SELECT category, product_name, {q.mean('rating')} AS avg_rating, count(*) AS reviews
  FROM prod JOIN rev USING (product_id) GROUP BY ALL HAVING count(*) >= 2)"""


@query("rank_variants", f"""SELECT *, row_number() OVER (PARTITION BY category ORDER BY avg_rating DESC, product_name) AS
  place, rank() OVER (PARTITION BY category ORDER BY avg_rating DESC) AS rank_gaps, dense_rank() OVER (PARTITION BY
  category ORDER BY avg_rating DESC) AS rank_dense FROM {RATINGS}""")
def rank_variants(m):
    r = product_ratings(m)
    by, key = Order("avg_rating", True), ["category"]
    hot = find_hot(r, key)
    r = in_order(r, key, [by, Order("product_name")], [Position("place")], hot=hot)
    return ranked(r, key, by, "rank_gaps", "rank_dense", hot=hot)


@query("spend_quartiles", f"""WITH c AS (SELECT customer_id, {q.money('order_total')} AS spent FROM ord
  WHERE order_status = 'delivered' GROUP BY customer_id), t AS (SELECT *, ntile(4) OVER (ORDER BY spent DESC, customer_id)
  AS quartile FROM c) SELECT *, CASE quartile WHEN 1 THEN 'top' WHEN 2 THEN 'upper' WHEN 3 THEN 'lower' ELSE 'bottom' END
  AS spend_group FROM t""")
def spend_quartiles(m):
    # One row per customer, counted several times to find the borders: stored once.
    spent = durable(m.orders("delivered").groupBy("customer_id").agg(money("order_total").alias("spent")))
    t = tiles_of_all(spent, [Order("spent", True), Order("customer_id")], 4, "quartile")
    names = F.array(*[F.lit(x) for x in ("top", "upper", "lower", "bottom")])
    return t.withColumn("spend_group", F.element_at(names, F.col("quartile").cast("int")))


@query("price_deciles", f"""WITH p AS (SELECT product_id, unit_price, ntile(10) OVER (ORDER BY unit_price, product_id) AS
  decile FROM prod) SELECT decile, count(DISTINCT p.product_id) AS products, min(unit_price) AS from_price, max(unit_price)
  AS to_price, count(rating) AS reviews, {q.mean('rating')} AS avg_rating FROM p LEFT JOIN rev USING (product_id)
  GROUP BY decile""")
def price_deciles(m):
    """Price tenth against rating; reviews are summed per product first."""
    p = tiles_of_all(m.products().select("product_id", "unit_price"), [Order("unit_price"), Order("product_id")], 10, "decile")
    r = m.reviews().groupBy("product_id").agg(rows().alias("n"), F.sum("rating").alias("stars"))
    return p.join(r, "product_id", "left").groupBy("decile").agg(
        rows().alias("products"),
        F.min("unit_price").alias("from_price"),
        F.max("unit_price").alias("to_price"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("reviews"),
        r2(F.sum("stars") / F.sum("n")).alias("avg_rating"),
    )


@query("month_over_month", f"""SELECT order_month, revenue, lag(revenue) OVER w AS before, round(revenue - lag(revenue)
  OVER w, 2) AS change, {q.r2('(revenue - lag(revenue) OVER w) * 100 / nullif(lag(revenue) OVER w, 0)')} AS change_pct,
  buyers - lag(buyers) OVER w AS new_buyer_change FROM {MONTHS} LEFT JOIN (SELECT first_month AS order_month, count(*) AS
  buyers FROM (SELECT {q.month('min(created_at)')} AS first_month FROM ord WHERE order_status = 'delivered'
  GROUP BY customer_id) GROUP BY 1) USING (order_month) WINDOW w AS (ORDER BY order_month)""")
def month_over_month(m):
    first = m.orders("delivered").groupBy("customer_id").agg(month(F.min("created_at")).alias("order_month"))
    buyers = first.groupBy("order_month").agg(rows().alias("buyers"))
    r = month_revenue(m).select("order_month", "revenue").join(buyers, "order_month", "left")
    now, before = F.col("revenue"), F.lag("revenue").over(calendar())
    return r.select(
        "order_month",
        "revenue",
        before.alias("before"),
        F.round(now - before, 2).alias("change"),
        r2((now - before) * 100 / F.nullif(before, F.lit(0.0))).alias("change_pct"),
        (F.col("buyers") - F.lag("buyers").over(calendar())).alias("new_buyer_change"),
    )


@query("next_order_gap", """SELECT customer_id, order_id, created_at, lead(created_at) OVER w AS next_at, date_diff('day',
  CAST(created_at AS DATE), CAST(lead(created_at) OVER w AS DATE)) AS days_to_next FROM ord
  WINDOW w AS (PARTITION BY customer_id ORDER BY created_at, order_id)""")
def next_order_gap(m):
    o = m.orders().select("customer_id", "order_id", "created_at")
    o = in_order(o, ["customer_id"], BY_DATE, [Neighbour("next_at", "created_at", +1)])
    return o.withColumn("days_to_next", F.datediff("next_at", "created_at").cast("bigint"))


@query("running_total", f"""SELECT order_month, revenue, round(sum(revenue) OVER (ORDER BY order_month
  ROWS UNBOUNDED PRECEDING), 2) AS so_far, {q.r2('round(sum(revenue) OVER (ORDER BY order_month ROWS UNBOUNDED PRECEDING), 2)'
  ' * 100 / round(sum(revenue) OVER (), 2)')} AS pct_of_total FROM {MONTHS}""")
def running_total(m):
    r = month_revenue(m).select("order_month", "revenue")
    so_far = F.round(F.sum("revenue").over(calendar().rowsBetween(Window.unboundedPreceding, 0)), 2)
    whole = F.round(F.sum("revenue").over(Window.partitionBy()), 2)
    return r.withColumns({"so_far": so_far, "pct_of_total": r2(so_far * 100 / whole)})


@query("moving_average", f"""SELECT order_month, revenue, {q.r2('round(sum(revenue) OVER (ORDER BY order_month ROWS 2'
  ' PRECEDING), 2) / count(*) OVER (ORDER BY order_month ROWS 2 PRECEDING)')} AS avg_3, {q.r2('round(sum(revenue) OVER'
  ' (ORDER BY order_month ROWS 5 PRECEDING), 2) / count(*) OVER (ORDER BY order_month ROWS 5 PRECEDING)')} AS avg_6,
  {q.r2('revenue * 100 / round(sum(revenue) OVER (), 2)')} AS pct_of_total, refunds, {q.r2('sum(refunds) OVER (ORDER BY'
  ' order_month ROWS 2 PRECEDING) / count(*) OVER (ORDER BY order_month ROWS 2 PRECEDING)')} AS refunds_avg_3
  FROM {MONTHS} LEFT JOIN (SELECT {q.month('shipped_at')} AS order_month, count(*) AS refunds FROM ret GROUP BY 1)
  USING (order_month)""")
def moving_average(m):
    refunds = m.returns().groupBy(month("shipped_at").alias("order_month")).agg(rows().alias("refunds"))
    r = month_revenue(m).select("order_month", "revenue").join(refunds, "order_month", "left")

    def over_last(column, n):
        w = calendar().rowsBetween(1 - n, 0)
        return r2(F.round(F.sum(column).over(w), 2) / F.count(F.lit(1)).over(w))

    whole = F.round(F.sum("revenue").over(Window.partitionBy()), 2)
    return r.withColumns(
        {
            "avg_3": over_last("revenue", 3),
            "avg_6": over_last("revenue", 6),
            "pct_of_total": r2(F.col("revenue") * 100 / whole),
            "refunds_avg_3": over_last("refunds", 3),
        }
    )


@query("gap_to_best", f"""SELECT category, product_name, avg_rating, first_value(product_name) OVER w AS best_product,
  first_value(avg_rating) OVER w AS best_rating, last_value(product_name) OVER w AS worst_product,
  round(avg_rating - first_value(avg_rating) OVER w, 2) AS gap FROM {RATINGS} WINDOW w AS (PARTITION BY category
  ORDER BY avg_rating DESC, product_name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def gap_to_best(m):
    """First and last value of a full frame are a minimum and a maximum per group:
    two combinable aggregates instead of a sort of each category."""
    r = product_ratings(m).drop("reviews")
    place = F.struct((-F.col("avg_rating")).alias("r"), F.col("product_name").alias("n"))
    ends = r.groupBy("category").agg(
        F.min(place).alias("best"), F.max(place).alias("worst"), rows().alias("_n")
    )
    ends = ends.select(
        "category",
        "_n",
        F.col("best.n").alias("best_product"),
        (-F.col("best.r")).alias("best_rating"),
        F.col("worst.n").alias("worst_product"),
    )
    both = attach(r, ends, ["category"], "_n", ["product_name"]).drop("_n")
    return both.withColumn("gap", F.round(F.col("avg_rating") - F.col("best_rating"), 2))


@query("customer_behaviour", f"""SELECT customer_id, order_id, order_total, created_at, row_number() OVER w AS order_no,
  round(sum(order_total) OVER (PARTITION BY customer_id ORDER BY created_at, order_id ROWS UNBOUNDED PRECEDING), 2) AS
  spent_so_far, date_diff('day', CAST(lag(created_at) OVER w AS DATE), CAST(created_at AS DATE)) AS days_since_last,
  {q.r2('order_total - round(sum(order_total) OVER p, 2) / count(*) OVER p')} AS vs_own_avg,
  rank() OVER (PARTITION BY customer_id ORDER BY order_total DESC) AS spend_rank FROM ord
  WHERE order_status = 'delivered' AND customer_id IN (SELECT customer_id FROM ord GROUP BY customer_id
  HAVING count(*) >= 5) WINDOW w AS (PARTITION BY customer_id ORDER BY created_at, order_id),
  p AS (PARTITION BY customer_id)""")
def customer_behaviour(m):
    """Five views of each order within its customer's history."""
    per = m.orders().groupBy("customer_id").agg(
        rows().alias("_n"),
        F.count_if(F.col("order_status") == "delivered").alias("_done"),
        F.sum(F.when(F.col("order_status") == "delivered", F.col("order_total"))).alias("_spent"),
    )
    regular = per.filter(F.col("_n") >= 5)
    o = m.orders("delivered").select("customer_id", "order_id", "order_total", "created_at")
    o = attach(o, regular, ["customer_id"], "_n", ["order_id"])
    o = o.withColumn("vs_own_avg", r2(F.col("order_total") - F.round("_spent", 2) / F.col("_done")))
    o = o.drop("_n", "_done", "_spent")
    key = ["customer_id"]
    hot = find_hot(m.orders("delivered"), key)
    history = [Position("order_no"), Running("spent_so_far", "order_total"), Neighbour("_last", "created_at")]
    o = in_order(o, key, BY_DATE, history, hot=hot)
    o = ranked(o, key, Order("order_total", True), "spend_rank", "_dense", hot=hot)
    return o.withColumns(
        {
            "spent_so_far": F.round("spent_so_far", 2),
            "days_since_last": F.datediff("created_at", "_last").cast("bigint"),
        }
    ).drop("_last", "_dense")


@query("best_product_per_supplier", f"""SELECT supplier_id, product_id, avg_rating, reviews FROM (SELECT supplier_id,
  product_id, {q.mean('rating')} AS avg_rating, count(*) AS reviews FROM prod JOIN rev USING (product_id) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY supplier_id ORDER BY avg_rating DESC, reviews DESC, product_id) = 1""")
def best_product_per_supplier(m):
    rated = m.reviews().groupBy("product_id").agg(mean("rating").alias("avg_rating"), rows().alias("reviews"))
    r = rated.join(m.products().select("product_id", "supplier_id"), "product_id")
    order = [Order("avg_rating", True), Order("reviews", True), Order("product_id")]
    return best_per_group(r, ["supplier_id"], order, 1, "_p").drop("_p")


@query("best_above_average", f"""WITH a AS (SELECT *, {q.r2('round(sum(order_total) OVER p, 2) / count(*) OVER p')} AS
  own_avg FROM ord WHERE order_status = 'delivered' WINDOW p AS (PARTITION BY customer_id))
  SELECT customer_id, order_id, order_total, own_avg FROM a WHERE order_total > own_avg
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_total DESC, order_id) = 1""")
def best_above_average(m):
    """The best order and the average come from one grouping; the best one is above
    the average exactly when any is."""
    best = F.max(F.struct("order_total", (-F.col("order_id")).alias("minus_id")))
    g = m.orders("delivered").groupBy("customer_id").agg(best.alias("b"), mean("order_total").alias("own_avg"))
    return g.filter(F.col("b.order_total") > F.col("own_avg")).select(
        "customer_id", (-F.col("b.minus_id")).alias("order_id"), "b.order_total", "own_avg"
    )
