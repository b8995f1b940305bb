"""Joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.functions.scalar import mean, money, month, pct, refunded, rows, total_of
from cartloom.operators.groups import Order, Position, attach, first_rows, in_order
from cartloom.plans import oracle as q
from cartloom.plans.registry import query


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def between(column, start, end):
    return (F.col(column) >= ts(start)) & (F.col(column) < ts(end))


@query("join_inner", """SELECT customer_id, customer_name, country, segment, order_id, order_status, order_total,
  created_at FROM cust JOIN ord USING (customer_id) WHERE order_status = 'delivered' AND order_total > 300000""")
def join_inner(m):
    o = m.orders("delivered").filter(F.col("order_total") > 300000)
    c = m.customers().select("customer_id", "customer_name", "country", "segment")
    return c.join(o, "customer_id").select(
        *c.columns, "order_id", "order_status", "order_total", "created_at"
    )


@query("join_three_way", f"""SELECT customer_id, customer_name, segment, count(DISTINCT order_id) AS orders,
  count(*) AS items, {q.money('line_total')} AS revenue FROM cust JOIN ord USING (customer_id) JOIN item USING (order_id)
  WHERE order_status = 'delivered' GROUP BY ALL ORDER BY revenue DESC, customer_id LIMIT 10""")
def join_three_way(m):
    """Items are summed per order first: each order is then one row, so counting
    orders needs no distinct, and names are joined to the ten winners' rows only."""
    per_order = per_order_totals(m)
    best = (
        m.orders("delivered")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            rows().alias("orders"),
            F.sum("items").alias("items"),
            total_of("total").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(10)
    )
    return best.join(m.customers().select("customer_id", "customer_name", "segment"), "customer_id")


def per_order_totals(m):
    return m.items().groupBy("order_id").agg(rows().alias("items"), F.sum("line_total").alias("total"))


@query("join_left_on_pred", """SELECT customer_id, customer_name, country, segment FROM cust
  LEFT JOIN (SELECT customer_id AS buyer, order_id FROM ord WHERE year(created_at) = 1999) ON buyer = customer_id
  WHERE order_id IS NULL""")
def join_left_on_pred(m):
    """Customers without an order in a year: the right side is cut to the year and
    to distinct buyers before it is shuffled."""
    buyers = m.orders().filter(between("created_at", "1999-01-01", "2000-01-01")).select("customer_id").distinct()
    c = m.customers().select("customer_id", "customer_name", "country", "segment")
    return c.join(buyers, "customer_id", "left_anti")


@query("join_left_default", """SELECT order_id, product_id, CAST(line_no AS BIGINT) AS line_no, line_total, refunds,
  coalesce(refund_status, 'not_returned') AS refund_status FROM item LEFT JOIN (SELECT order_id, product_id, line_no,
  count(*) AS refunds, 'returned' AS refund_status FROM ret GROUP BY ALL) USING (order_id, product_id, line_no)""")
def join_left_default(m):
    key = ["order_id", "product_id", "line_no"]
    refunds = m.returns().groupBy(*key).agg(rows().alias("refunds"))
    refunds = refunds.withColumn("refund_status", F.lit("returned"))
    lines = m.items().select(*key, "line_total").join(refunds, key, "left")
    return lines.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn(
        "refund_status", F.coalesce("refund_status", F.lit("not_returned"))
    )


@query("join_right", """SELECT c.customer_id, o.order_id FROM ord o RIGHT JOIN cust c ON o.customer_id = c.customer_id""")
def join_right(m):
    return m.orders().select("customer_id", "order_id").join(m.customers().select("customer_id"), "customer_id", "right")


@query("join_full_reconcile", """SELECT p.product_id AS catalog_id, i.product_id AS sold_id, coalesce(times_sold, 0) AS
  times_sold, CASE WHEN i.product_id IS NULL THEN 'catalog only' WHEN p.product_id IS NULL THEN 'sales only' ELSE 'both'
  END AS found_in FROM prod p FULL JOIN (SELECT product_id, count(*) AS
  times_sold FROM item GROUP BY product_id) i ON p.product_id = i.product_id""")
def join_full_reconcile(m):
    """Items are counted per product before the full join, which then pairs keys
    that are unique on both sides."""
    catalog = m.products().select(F.col("product_id").alias("catalog_id"))
    sold = (
        m.items()
        .groupBy(F.col("product_id").alias("sold_id"))
        .agg(rows().alias("times_sold"))
    )
    both = catalog.join(sold, F.col("catalog_id") == F.col("sold_id"), "full")
    where = F.when(F.col("sold_id").isNull(), "catalog only").when(F.col("catalog_id").isNull(), "sales only")
    return both.select(
        "catalog_id",
        "sold_id",
        F.coalesce("times_sold", F.lit(0)).alias("times_sold"),
        where.otherwise("both").alias("found_in"),
    )


@query("never_ordered", """SELECT product_id, product_name, category, unit_price FROM
  (SELECT product_id, product_name, category, unit_price FROM prod UNION ALL SELECT
  (SELECT max(product_id) FROM prod) + row_number() OVER (ORDER BY category), 'new ' || category, category, min(unit_price)
  FROM prod GROUP BY category) WHERE product_id NOT IN (SELECT product_id FROM item)""")
def never_ordered(m):
    """The catalogue and one product per category announced but not sold yet."""
    sold = m.items().select("product_id").distinct()
    p = m.products().select("product_id", "product_name", "category", "unit_price")
    announced = p.groupBy("category").agg(F.min("unit_price").alias("unit_price"), F.max("product_id").alias("_last"))
    rank, last = F.row_number().over(Window.orderBy("category")), F.max("_last").over(Window.partitionBy())  # a row a category
    announced = announced.withColumn("product_id", last + rank).drop("_last")
    p = p.unionByName(announced.withColumn("product_name", F.concat(F.lit("new "), "category")))
    return p.join(sold, "product_id", "left_anti")


@query("join_composite", f"""WITH r AS (SELECT order_id, product_id, supplier_id, count(*) AS refunds,
  {q.REFUNDED} AS refunded FROM ret GROUP BY ALL), i AS (SELECT order_id, product_id, supplier_id,
  CAST(sum(quantity) AS BIGINT) AS units, {q.money('line_total')} AS sold FROM item GROUP BY ALL)
  SELECT order_id, product_id, supplier_id, refunds, refunded, units, sold FROM r JOIN i USING (order_id, product_id, supplier_id)""")
def join_composite(m):
    """Both sides are unique on the three-column key before they meet, and the
    aggregation already partitions them by it."""
    key = ["order_id", "product_id", "supplier_id"]
    refunds = m.returns().groupBy(*key).agg(rows().alias("refunds"), refunded().alias("refunded"))
    sold = m.items().groupBy(*key).agg(
        F.sum("quantity").cast("bigint").alias("units"), money("line_total").alias("sold")
    )
    return refunds.join(sold, key)


@query("join_fanout_audit", """WITH f AS (SELECT o.order_id, count(i.order_id) AS fanout FROM ord o
  LEFT JOIN item i ON o.order_id = i.order_id GROUP BY o.order_id)
  SELECT fanout, count(*) AS orders, CAST(sum(fanout) AS BIGINT) AS joined_rows,
  (SELECT count(*) FROM ord) AS left_rows, (SELECT count(*) FROM item) AS right_rows FROM f GROUP BY fanout""")
def join_fanout_audit(m):
    """Rows per key and the size of the join, without building the join."""
    per_key = m.items().groupBy("order_id").agg(rows().alias("fanout"))
    o = m.orders().select("order_id").join(per_key, "order_id", "left")
    fan = o.groupBy(F.coalesce("fanout", F.lit(0)).alias("fanout")).agg(rows().alias("orders"))
    return fan.select(
        "fanout",
        "orders",
        (F.col("fanout") * F.col("orders")).alias("joined_rows"),
        m.orders().agg(rows()).scalar().alias("left_rows"),
        m.items().agg(rows()).scalar().alias("right_rows"),
    )


@query("join_cross", """SELECT region, status AS order_status, coalesce(n, 0) AS orders, coalesce(t, 0) AS revenue
  FROM (SELECT DISTINCT region FROM cust) CROSS JOIN (SELECT DISTINCT order_status AS status FROM ord)
  LEFT JOIN (SELECT region AS r, order_status AS s, count(*) AS n, round(sum(order_total), 2) AS t FROM ord
  JOIN cust USING (customer_id) GROUP BY ALL) ON r = region AND s = status""")
def join_cross(m):
    """Every region with every status, zero where nothing happened.  The status
    list is one array value, spread over the regions without a product of rows."""
    statuses = m.orders().agg(F.sort_array(F.collect_set("order_status"))).scalar()
    grid = m.table("region").select(F.col("r_name").alias("region"), F.explode(statuses).alias("order_status"))
    seen = (
        m.orders().join(m.customers().select("customer_id", "region"), "customer_id")
        .groupBy("region", "order_status")
        .agg(rows().alias("orders"), F.round(F.sum("order_total"), 2).alias("revenue"))
    )
    return grid.join(seen, ["region", "order_status"], "left").fillna(0, ["orders", "revenue"])


@query("join_self", """WITH s AS (SELECT customer_id, order_id, order_total, row_number() OVER (PARTITION BY customer_id
  ORDER BY created_at, order_id) AS n FROM ord) SELECT a.customer_id, a.order_id AS earlier_id, b.order_id AS later_id,
  round(b.order_total - a.order_total, 2) AS growth FROM s a JOIN s b ON a.customer_id = b.customer_id AND b.n = a.n + 1
  WHERE b.order_total > a.order_total""")
def join_self(m):
    """Rows of one table compared with each other: each order with the customer's
    next one.  The join key holds the place in the sequence, so a pair of rows
    meets once and no key collects a whole customer."""
    o = m.orders().select("customer_id", "order_id", "order_total", "created_at")
    s = in_order(o, ["customer_id"], [Order("created_at"), Order("order_id")], [Position("n")])
    a = s.select("customer_id", F.col("order_id").alias("earlier_id"), F.col("order_total").alias("before"), "n")
    b = s.select(
        "customer_id", F.col("order_id").alias("later_id"), F.col("order_total").alias("after"), (F.col("n") - 1).alias("n")
    )
    pairs = a.join(b, ["customer_id", "n"]).filter(F.col("after") > F.col("before"))
    return pairs.select(
        "customer_id", "earlier_id", "later_id", F.round(F.col("after") - F.col("before"), 2).alias("growth")
    )


@query("join_semi", """SELECT order_id, customer_id, order_total FROM ord WHERE customer_id IN
  (SELECT customer_id FROM ord GROUP BY customer_id HAVING count(*) >= 15)""")
def join_semi(m):
    o = m.orders().select("order_id", "customer_id", "order_total")
    loyal = o.groupBy("customer_id").agg(rows().alias("n")).filter(F.col("n") >= 15)
    # The list is unique per customer, so attaching it is a semi join.
    return attach(o, loyal, ["customer_id"], "n", ["order_id"]).drop("n")


@query("lapsed_customers", f"""SELECT customer_id, count(*) AS orders, {q.money('order_total')} AS revenue FROM ord
  WHERE year(created_at) = 1999 AND customer_id NOT IN (SELECT customer_id FROM ord WHERE year(created_at) = 2000)
  GROUP BY customer_id""")
def lapsed_customers(m):
    """Summed per customer before the anti join, so both sides are unique."""
    in_year = lambda y: m.orders().filter(between("created_at", f"{y}-01-01", f"{y + 1}-01-01"))
    before = in_year(1999).groupBy("customer_id").agg(rows().alias("orders"), money("order_total").alias("revenue"))
    return before.join(in_year(2000).select("customer_id").distinct(), "customer_id", "left_anti")


@query("join_enrich_daily", f"""WITH daily AS (SELECT s.region AS area, CAST(shipped_at AS DATE) AS day,
  count(*) AS parcels, {q.mean('quantity')} AS avg_load FROM item i JOIN supp s ON i.supplier_id = s.supplier_id
  GROUP BY ALL), market AS (SELECT n_name AS country, r_name AS area, upper(left(r_name, 2)) || '-' ||
  CAST(n_nationkey AS VARCHAR) AS market FROM nation JOIN region ON n_regionkey = r_regionkey)
  SELECT CAST(o.created_at AS DATE) AS day, market, m.country, parcels, avg_load, count(*) AS orders,
  {q.money('order_total')} AS revenue FROM ord o JOIN cust c ON o.customer_id = c.customer_id
  JOIN market m ON m.country = c.country JOIN daily d ON d.day = CAST(o.created_at AS DATE) AND d.area = m.area
  GROUP BY ALL""")
def join_enrich_daily(m):
    """Orders per day and market, enriched from a daily table by (day, area).

    Orders are counted per day and country before the enrichment, so the daily
    join sees one row per day and market."""
    suppliers = m.suppliers().select("supplier_id", F.col("region").alias("area"))
    daily = (
        m.items()
        .join(suppliers, "supplier_id")
        .groupBy("area", F.col("shipped_at").cast("date").alias("day"))
        .agg(rows().alias("parcels"), mean("quantity").alias("avg_load"))
    )
    geo = m.geography()
    markets = geo.select(
        "country",
        F.col("region").alias("area"),
        F.concat(F.upper(F.left("region", F.lit(2))), F.lit("-"), F.col("n_nationkey").cast("string")).alias("market"),
    )
    orders = (
        m.orders()
        .join(m.customers().select("customer_id", "country"), "customer_id")
        .groupBy(F.col("created_at").cast("date").alias("day"), "country")
        .agg(rows().alias("orders"), money("order_total").alias("revenue"))
    )
    return orders.join(markets, "country").join(daily, ["area", "day"]).drop("area")


@query("join_json_field", f"""SELECT country, count(*) AS events, {q.money('value')} AS value
  FROM click JOIN supp ON CAST(json_extract(props, '$.k') AS BIGINT) = supplier_id GROUP BY country""")
def join_json_field(m):
    field = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    per_key = m.clicks().groupBy(field.alias("supplier_id")).agg(rows().alias("n"), F.sum("value").alias("v"))
    per_country = per_key.join(m.suppliers().select("supplier_id", "country"), "supplier_id").groupBy("country")
    return per_country.agg(
        F.sum("n").alias("events"), total_of("v").alias("value")
    )


@query("core_revenue", f"""SELECT country, category, {q.month('created_at')} AS order_month, {q.money('line_total')} AS
  revenue, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers FROM ord
  JOIN cust USING (customer_id) JOIN item USING (order_id) JOIN prod USING (product_id)
  WHERE order_status = 'delivered' GROUP BY ALL""")
def core_revenue(m):
    """The flagship.  Both distinct counts come from pre-grouping: rows are first
    summed per (order, category), where an order counts once, then per (customer,
    group), where a customer counts once.  No row is expanded per distinct."""
    orders = m.orders("delivered").select("order_id", "customer_id", month("created_at").alias("order_month"))
    per_order = (
        m.items()
        .select("order_id", "product_id", "line_total")
        .join(m.products().select("product_id", "category"), "product_id")
        .join(orders, "order_id")
        .groupBy("order_id", "category", "customer_id", "order_month")
        .agg(F.sum("line_total").alias("total"))
    )
    per_customer = (
        per_order.join(m.customers().select("customer_id", "country"), "customer_id")
        .groupBy("country", "category", "order_month", "customer_id")
        .agg(F.sum("total").alias("total"), rows().alias("orders"))
    )
    return per_customer.groupBy("country", "category", "order_month").agg(
        total_of("total").alias("revenue"),
        F.sum("orders").alias("orders"),
        rows().alias("customers"),
    )


@query("supplier_report", f"""WITH s AS (SELECT i.supplier_id, count(DISTINCT order_id) AS orders, count(*) AS items,
  {q.money('line_total')} AS revenue, count(*) FILTER (return_flag = 'R') AS refunds FROM item i JOIN ord USING (order_id)
  WHERE order_status = 'delivered' GROUP BY i.supplier_id HAVING count(*) > 100), v AS (SELECT supplier_id,
  {q.mean('rating')} AS avg_rating FROM rev JOIN prod USING (product_id) GROUP BY supplier_id)
  SELECT supplier_id, supplier_name, country, orders, items, revenue, refunds,
  {q.r2('100e0 * refunds / nullif(items, 0)')} AS refund_pct, avg_rating FROM s JOIN supp USING (supplier_id)
  LEFT JOIN v USING (supplier_id)""")
def supplier_report(m):
    """Sales, refunds and ratings are each summed per supplier before they meet,
    so that no measure is multiplied by another's rows."""
    per_order = (
        m.items()
        .select("order_id", "supplier_id", "line_total", "return_flag")
        .join(m.orders("delivered").select("order_id"), "order_id")
        .groupBy("order_id", "supplier_id")
        .agg(
            rows().alias("items"),
            F.sum("line_total").alias("total"),
            F.count_if(F.col("return_flag") == "R").alias("refunds"),
        )
    )
    sales = (
        per_order.groupBy("supplier_id")
        .agg(
            rows().alias("orders"),
            F.sum("items").alias("items"),
            total_of("total").alias("revenue"),
            F.sum("refunds").alias("refunds"),
        )
        .filter(F.col("items") > 100)
        .withColumn("refund_pct", pct(F.col("refunds"), F.col("items")))
    )
    names = m.suppliers().select("supplier_id", "supplier_name", "country")
    return sales.join(names, "supplier_id").join(supplier_ratings(m), "supplier_id", "left")


def supplier_ratings(m):
    made = m.products().select("product_id", "supplier_id")
    return (
        m.reviews().select("product_id", "rating").join(made, "product_id")
        .groupBy("supplier_id").agg(mean("rating").alias("avg_rating"))
    )


@query("sort_large_join", """SELECT order_id, customer_id, created_at, product_id, CAST(line_no AS BIGINT) AS line_no,
  quantity, gross FROM ord JOIN item USING (order_id)
  ORDER BY created_at DESC, order_id, product_id, line_no, gross, quantity LIMIT 500000""")
def sort_large_join(m):
    order = [Order("created_at", True)] + [
        Order(c) for c in ("order_id", "product_id", "line_no", "gross", "quantity")
    ]
    lines = m.items().select(
        "order_id", "product_id", F.col("line_no").cast("bigint").alias("line_no"), "quantity", "gross"
    )
    joined = m.orders().select("order_id", "customer_id", "created_at").join(lines, "order_id")
    return first_rows(joined, order, 500_000, F.col("created_at").cast("date"), True)
