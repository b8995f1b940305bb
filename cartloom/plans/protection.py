"""Masking, row filters and protected sharing; and the user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions import history, udfs
from cartloom.functions.scalar import mean, money, month, rows
from cartloom.operators import protect
from cartloom.plans import oracle as q
from cartloom.plans.registry import query

# The roles of the examples and what they inherit.
INHERITS = {"analyst": [], "auditor": ["analyst"], "rep": ["rep_asia", "rep_europe"], "manager": ["rep"]}
CLEARED = {"auditor"}
RULES = {"email": "short_email", "phone": "last_four", "customer_name": "first_letter", "segment": "full"}

SHORT_EMAIL = """CASE WHEN contains(email, '@') THEN left(email, 2) || '***@' || split_part(email, '@', -1)
  ELSE '***MASKED***' END"""
FIRST = "left(customer_name, 1) || repeat('*', length(customer_name) - 1)"


@query("mask_columns", f"""SELECT 'analyst' AS viewer, customer_id, {FIRST} AS customer_name, {SHORT_EMAIL} AS email,
  '***-***-' || right(phone, 4) AS phone, '***MASKED***' AS segment FROM cust
  UNION ALL SELECT 'auditor', customer_id, customer_name, email, phone, segment FROM cust""")
def mask_columns(m):
    c = m.customers().select("customer_id", "customer_name", "email", "phone", "segment")

    def seen_by(role):
        masked = protect.mask_columns(c, RULES, protect.held_roles(role, INHERITS), CLEARED)
        return masked.withColumn("viewer", F.lit(role))

    return seen_by("analyst").unionByName(seen_by("auditor"))


TAGS = {"email": "contact", "phone": "contact", "supplier_name": "name", "customer_name": "name", "balance": "money"}
POLICIES = {("contact", "string"): "full", ("name", "string"): "first_letter"}


@query("mask_by_tag", f"""SELECT customer_id AS party_id, {FIRST} AS customer_name, '***MASKED***' AS email, region,
  CAST(NULL AS VARCHAR) AS supplier_name FROM cust UNION ALL SELECT supplier_id, NULL, NULL, region,
  left(supplier_name, 1) || repeat('*', length(supplier_name) - 1) FROM supp""")
def mask_by_tag(m):
    """One tag map masks two tables; money has no mask and is removed."""
    roles = protect.held_roles("analyst", INHERITS)
    c = m.customers().select(F.col("customer_id").alias("party_id"), "customer_name", "email", "region", "balance")
    s = m.suppliers().select(F.col("supplier_id").alias("party_id"), "supplier_name", "region", "balance")
    masked = [protect.mask_by_tag(df, TAGS, POLICIES, roles, CLEARED) for df in (c, s)]
    return masked[0].unionByName(masked[1], allowMissingColumns=True)


def access_map(m):
    """(role, region) pairs, one representative role per region."""
    return m.table("region").select(
        F.concat(F.lit("rep_"), F.lower("r_name")).alias("role"), F.col("r_name").alias("value")
    )


@query("row_filter", """SELECT 'rep' AS viewer, customer_id, region, segment FROM cust WHERE region IN ('ASIA', 'EUROPE')
  UNION ALL SELECT 'manager', customer_id, region, segment FROM cust""")
def row_filter(m):
    """A representative sees the own regions, a manager all, an unmapped role none."""
    c = m.customers().select("customer_id", "region", "segment")

    def seen_by(role):
        held = protect.held_roles(role, INHERITS)
        return protect.row_filter(c, access_map(m), "region", held, {"manager"}).withColumn("viewer", F.lit(role))

    return seen_by("rep").unionByName(seen_by("manager")).unionByName(seen_by("analyst"))


@query("protected_view", f"""SELECT order_id, {FIRST} AS customer_name, region, order_status, {SHORT_EMAIL} AS email,
  created_at FROM ord JOIN cust USING (customer_id) WHERE order_status <> 'placed' AND region IN ('ASIA', 'EUROPE')""")
def protected_view(m):
    """Customers are filtered and masked before the join; order value stays hidden."""
    held = protect.held_roles("rep", INHERITS)
    c = m.customers().select("customer_id", "customer_name", "region", "email")
    c = protect.row_filter(c, access_map(m), "region", held, {"manager"})
    c = protect.mask_columns(c, RULES, held, CLEARED)
    o = m.orders("delivered", "shipped").select("order_id", "customer_id", "order_status", "created_at")
    return o.join(c, "customer_id").drop("customer_id")


@query("overlap_counts", """SELECT segment, count(*) AS members FROM cust WHERE balance > 5000 AND customer_id IN
  (SELECT customer_id FROM ord WHERE shipping_method = '1-URGENT') GROUP BY segment HAVING count(*) >= 5""")
def overlap_counts(m):
    rich = m.customers().filter(F.col("balance") > 5000)
    rush = m.orders().filter(F.col("shipping_method") == "1-URGENT")
    return protect.overlap_counts(rich, rush, "customer_id", "segment", least=5)


@query("noisy_counts")
def noisy_counts(m):
    return protect.noisy_counts(m.customers(), "segment", epsilon=0.5, seed=17)


# --- user-defined functions --------------------------------------------------------

STEPS = [(400000, "enterprise"), (200000, "premium"), (50000, "standard")]


@query("udf_margin_tier", f"""SELECT CASE WHEN order_total >= 400000 THEN 'enterprise' WHEN order_total >= 200000 THEN
  'premium' WHEN order_total >= 50000 THEN 'standard' ELSE 'micro' END AS tier, CASE order_status WHEN 'placed' THEN
  'Order Received' WHEN 'shipped' THEN 'On Its Way' WHEN 'delivered' THEN 'Delivered' ELSE 'Unknown Status' END AS label,
  count(*) AS orders, {q.money('order_total')} AS revenue, {q.mean('order_total')} AS avg_order FROM ord GROUP BY ALL""")
def udf_margin_tier(m):
    tier = udfs.order_tier(F.col("order_total"), STEPS, "micro")
    label = udfs.status_label(F.col("order_status"))
    return m.orders().groupBy(tier.alias("tier"), label.alias("label")).agg(
        rows().alias("orders"), money("order_total").alias("revenue"), mean("order_total").alias("avg_order")
    )


@query("udf_sql_function", f"""SELECT product_id, {q.r2('nullif(unit_price - cost_price, 0) / nullif(unit_price, 0) * 100')}
  AS margin_pct, {q.r2('size * 10 + unit_price * CAST(0.01 AS DOUBLE) + supplier_id * CAST(0.5 AS DOUBLE)')} AS score FROM prod""")
def udf_sql_function(m):
    """The margin rule called as a SQL function, the score as a column function."""
    udfs.register_sql_functions(m.spark)
    return m.products().select(
        "product_id",
        F.expr("gross_margin_pct(unit_price, cost_price)").alias("margin_pct"),
        udfs.customer_score(F.col("size"), F.col("unit_price"), F.col("supplier_id")).alias("score"),
    )


@query("udf_clean_phone", """SELECT customer_id, CASE WHEN balance < 0 THEN '+1 ' || phone WHEN segment = 'BUILDING' THEN 'none'
  ELSE phone END AS raw, CASE WHEN balance < 0 THEN '1' || replace(phone, '-', '') WHEN segment = 'BUILDING' THEN NULL ELSE
  '(' || substr(phone, 1, 3) || ') ' || substr(phone, 5, 3) || '-' || substr(phone, 9, 4) END AS phone FROM cust""")
def udf_clean_phone(m):
    raw = F.when(F.col("balance") < 0, F.concat(F.lit("+1 "), "phone"))
    raw = raw.when(F.col("segment") == "BUILDING", "none").otherwise(F.col("phone"))
    c = m.customers().select("customer_id", raw.alias("raw"))
    return c.withColumn("phone", udfs.clean_phone(F.col("raw")))


@query("udf_email_domain", """SELECT domain, count(*) AS customers FROM (SELECT CASE WHEN contains(email, '@')
  THEN lower(split_part(email, '@', 2)) END AS domain FROM cust) GROUP BY domain""")
def udf_email_domain(m):
    domain = udfs.email_domain(F.col("email"))
    return m.customers().groupBy(domain.alias("domain")).agg(rows().alias("customers"))


@query("udf_format_currency", """SELECT order_id, '$' || format('{:,.2f}', order_total) AS price FROM ord""")
def udf_format_currency(m):
    return m.orders().select("order_id", udfs.format_currency(F.col("order_total")).alias("price"))


@query("date_spine", f"""SELECT CAST(d AS DATE) AS day, count(order_id) AS orders, coalesce({q.money('order_total')}, 0) AS revenue
  FROM generate_series((SELECT CAST(min(created_at) AS DATE) FROM ord), (SELECT CAST(max(created_at) AS DATE) FROM ord),
  INTERVAL 1 DAY) s(d) LEFT JOIN (SELECT * FROM ord WHERE order_status = 'delivered')
  ON CAST(created_at AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def date_spine(m):
    """Every day of the period; days without an order count zero."""
    o = m.orders()
    day = F.col("created_at").cast("date")
    days = o.agg(F.explode(F.sequence(F.min(day), F.max(day))).alias("day"))
    per_day = m.orders("delivered").groupBy(day.alias("day")).agg(rows().alias("orders"), money("order_total").alias("revenue"))
    return days.join(per_day, "day", "left").fillna(0, ["orders", "revenue"])


@query("udtf_monthly_history", f"""WITH per AS (SELECT customer_id, {q.month('created_at')} AS order_month, count(*) AS orders,
  {q.money('order_total')} AS spent FROM ord GROUP BY ALL), span AS (SELECT customer_id, CAST(unnest(generate_series(min(order_month),
  max(order_month), INTERVAL 1 MONTH)) AS TIMESTAMP) AS order_month FROM per GROUP BY customer_id), filled AS (SELECT customer_id, order_month,
  coalesce(orders, 0) AS orders, coalesce(spent, 0) AS spent, count(*) FILTER (WHERE orders IS NULL) OVER (PARTITION BY customer_id
  ORDER BY order_month) AS gaps FROM span LEFT JOIN per USING (customer_id, order_month))
  SELECT customer_id, order_month, orders, spent, CAST(CASE WHEN orders = 0 THEN 0 ELSE count(*) FILTER (WHERE orders > 0) OVER
  (PARTITION BY customer_id, gaps ORDER BY order_month) END AS BIGINT) AS streak FROM filled""")
def udtf_monthly_history(m):
    """Every month from a customer's first to the last, empty ones filled, with the running
    number of months in a row that had orders.

    The function receives one row per (customer, month) summed beforehand, so its
    partition is as long as the calendar and not as the customer's order list.
    """
    per_month = m.orders().groupBy("customer_id", month("created_at").alias("order_month")).agg(
        rows().alias("orders"), money("order_total").alias("spent")
    )
    return history.monthly_history(per_month, "customer_id", "order_month", "orders")


@query("udf_vectorized", """SELECT order_id, product_id, CAST(line_no AS BIGINT) AS line_no, discount, CASE WHEN discount >= 0.3
  THEN 'heavy_discount' WHEN discount >= 0.15 THEN 'moderate_discount' WHEN discount > 0 THEN 'light_discount'
  ELSE 'no_discount' END AS tier FROM (SELECT order_id, product_id, line_no, discount * 4 AS discount FROM item)""")
def udf_vectorized(m):
    tier = udfs.vectorized(udfs.discount_tiers, T.StringType())
    i = m.items().select(
        "order_id", "product_id", F.col("line_no").cast("bigint").alias("line_no"), (F.col("discount") * 4).alias("discount")
    )
    return i.withColumn("tier", tier("discount"))
