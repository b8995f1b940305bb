"""Projection, predicates, schema change and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import money, month, r2, rows
from cartloom.operators import evolve
from cartloom.operators.groups import Order, dense_ids
from cartloom.plans import oracle as q
from cartloom.plans.registry import query

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


@query("filter_status", """SELECT order_id, customer_id, order_status, order_total, created_at
  FROM ord WHERE order_status = 'delivered'""")
def filter_status(m):
    return m.orders("delivered").select("order_id", "customer_id", "order_status", "order_total", "created_at")


@query("filter_date_range", """SELECT
  count(*) FILTER (created_at < TIMESTAMP '1998-01-01') AS year_orders,
  CAST(round(sum(order_total) FILTER (created_at < TIMESTAMP '1998-01-01'), 2) AS DOUBLE) AS year_revenue,
  count(*) AS between_orders, round(sum(order_total), 2) AS between_revenue
  FROM ord WHERE created_at >= TIMESTAMP '1997-01-01' AND created_at <= TIMESTAMP '1998-01-31 23:59:59'""")
def filter_date_range(m):
    """Half-open year and inclusive BETWEEN range from one pushed-down scan."""
    at = F.col("created_at")
    ts = lambda text: F.lit(text).cast("timestamp_ntz")
    o = m.orders().filter(at.between(ts("1997-01-01"), ts("1998-01-31 23:59:59")))
    half_open = at < ts("1998-01-01")
    return o.agg(
        F.count_if(half_open).alias("year_orders"),
        F.round(F.sum(F.when(half_open, F.col("order_total"))), 2).alias("year_revenue"),
        rows().alias("between_orders"),
        F.round(F.sum("order_total"), 2).alias("between_revenue"),
    )


@query("filter_multi", """SELECT order_id, order_status, shipping_method, order_total FROM ord
  WHERE order_status IN ('delivered', 'shipped') AND order_total > 100000
    AND (shipping_method = '1-URGENT' OR shipping_method = '2-HIGH' AND order_total > 300000)
  ORDER BY order_total DESC, order_id LIMIT 20""")
def filter_multi(m):
    total, method = F.col("order_total"), F.col("shipping_method")
    wanted = (method == "1-URGENT") | ((method == "2-HIGH") & (total > 300000))
    o = m.orders("delivered", "shipped").filter((total > 100000) & wanted)
    return (
        o.select("order_id", "order_status", "shipping_method", "order_total")
        .orderBy(F.desc("order_total"), "order_id")
        .limit(20)
    )


@query("filter_between", """SELECT product_id, product_name, category, unit_price FROM prod
  WHERE unit_price BETWEEN 920 AND 1050""")
def filter_between(m):
    p = m.products().filter(F.col("unit_price").between(920, 1050))
    return p.select("product_id", "product_name", "category", "unit_price")


@query("filter_like_ilike", """SELECT product_id, product_name, product_name LIKE 'small%' AS starts_small,
  product_name ILIKE '%RING%' AS has_ring FROM prod
  WHERE product_name LIKE 'small%' OR product_name ILIKE '%RING%'""")
def filter_like_ilike(m):
    name = F.col("product_name")
    small, ring = name.like("small%"), name.ilike("%RING%")
    p = m.products().filter(small | ring)
    return p.select("product_id", "product_name", small.alias("starts_small"), ring.alias("has_ring"))


@query("filter_is_null", """SELECT event_id, session_id, event_type, customer_id IS NULL AS anonymous
  FROM click WHERE customer_id IS NULL OR event_type IS NOT NULL AND event_type = 'signup'""")
def filter_is_null(m):
    who, kind = F.col("customer_id"), F.col("event_type")
    c = m.clicks().filter(who.isNull() | (kind.isNotNull() & (kind == "signup")))
    return c.select("event_id", "session_id", "event_type", who.isNull().alias("anonymous"))


@query("null_defaults", """SELECT event_id, customer_id + 5 AS plus_five, customer_id || ' suffix' AS with_suffix,
  coalesce(customer_id, -1) AS id_or_minus_one, coalesce(customer_id, 0) AS id_or_zero,
  coalesce(CAST(customer_id AS VARCHAR), 'anonymous') AS label FROM click""")
def null_defaults(m):
    who = F.col("customer_id")
    return m.clicks().select(
        "event_id",
        (who + 5).alias("plus_five"),
        F.concat(who.cast("string"), F.lit(" suffix")).alias("with_suffix"),
        F.nvl(who, F.lit(-1)).alias("id_or_minus_one"),
        F.zeroifnull(who).alias("id_or_zero"),
        F.coalesce(who.cast("string"), F.lit("anonymous")).alias("label"),
    )


@query("safe_margin", f"""SELECT product_id, unit_price, cost_price, unit_price - cost_price AS margin,
  {q.r2('(unit_price - cost_price) / nullif(unit_price, 0) * 100')} AS margin_pct FROM prod""")
def safe_margin(m):
    price, cost = F.col("unit_price"), F.col("cost_price")
    return m.products().select(
        "product_id",
        "unit_price",
        "cost_price",
        (price - cost).alias("margin"),
        r2((price - cost) / F.nullif(price, F.lit(0.0)) * 100).alias("margin_pct"),
    )


@query("case_segment", """SELECT order_id, order_total, CASE WHEN order_total >= 400000 THEN 'high'
  WHEN order_total >= 200000 THEN 'middle' WHEN order_total >= 50000 THEN 'low' ELSE 'micro' END AS band,
  CASE WHEN shipping_method = '1-URGENT' THEN 'rush' ELSE 'normal' END AS speed FROM ord""")
def case_segment(m):
    total = F.col("order_total")
    band = F.when(total >= 400000, "high").when(total >= 200000, "middle").when(total >= 50000, "low")
    return m.orders().select(
        "order_id",
        "order_total",
        band.otherwise("micro").alias("band"),
        F.expr("if(shipping_method = '1-URGENT', 'rush', 'normal')").alias("speed"),
    )


RAW_SIZE = "CASE WHEN size > 25 THEN subcategory ELSE CAST(size AS VARCHAR) END"


def raw_sizes(m, *keep):
    """Product sizes as untrusted text: some rows hold a brand name instead."""
    raw = F.when(F.col("size") > 25, F.col("subcategory")).otherwise(F.col("size").cast("string"))
    return m.products().select("product_id", raw.alias("raw_size"), *keep)


@query("cast_strict", """SELECT order_id, CAST(order_id AS VARCHAR) AS id_text,
  CAST(CAST(order_total AS VARCHAR) AS DOUBLE) AS total_back, CAST(created_at AS DATE) AS day,
  CAST(substr(shipping_method, 1, 1) AS BIGINT) AS urgency FROM ord""")
def cast_strict(m):
    return m.orders().select(
        "order_id",
        F.col("order_id").cast("string").alias("id_text"),
        F.col("order_total").cast("string").cast("double").alias("total_back"),
        F.col("created_at").cast("date").alias("day"),
        F.substring("shipping_method", 1, 1).cast("bigint").alias("urgency"),
    )


@query("try_cast_audit", f"""SELECT product_id, raw_size FROM (SELECT product_id, {RAW_SIZE} AS raw_size FROM prod)
  WHERE raw_size IS NOT NULL AND TRY_CAST(raw_size AS BIGINT) IS NULL""")
def try_cast_audit(m):
    raw = F.col("raw_size")
    return raw_sizes(m).filter(raw.isNotNull() & raw.try_cast("bigint").isNull())


@query("distinct_values", "SELECT DISTINCT category, subcategory FROM prod")
def distinct_values(m):
    return m.products().select("category", "subcategory").distinct()


@query("sort_nulls", """SELECT review_id, helpful_votes, quality FROM rev LEFT JOIN labels ON review_id = doc_id
  ORDER BY quality DESC NULLS LAST, helpful_votes ASC NULLS LAST, review_id""")
def sort_nulls(m):
    r = m.reviews().join(m.review_labels(), "review_id", "left")
    return r.select("review_id", "helpful_votes", F.col("quality").cast("int")).orderBy(
        F.desc_nulls_last("quality"), F.asc_nulls_last("helpful_votes"), "review_id"
    )


@query("top_k", """SELECT product_id, product_name, category, unit_price FROM prod
  ORDER BY unit_price DESC, product_id LIMIT 10""")
def top_k(m):
    p = m.products().select("product_id", "product_name", "category", "unit_price")
    return p.orderBy(F.desc("unit_price"), "product_id").limit(10)


@query("page_offset", """SELECT order_id, customer_id, order_total FROM ord
  ORDER BY order_total DESC, order_id LIMIT 10 OFFSET 20""")
def page_offset(m):
    o = m.orders().select("order_id", "customer_id", "order_total")
    return o.orderBy(F.desc("order_total"), "order_id").offset(20).limit(10)


@query("sample_rows")
def sample_rows(m):
    return m.clicks().sample(fraction=0.1, seed=11).select("event_id", "event_type", "value")


@query("df_chain", f"""SELECT order_id, customer_name, country, order_total, created_at,
  {q.r2('order_total - balance')} AS headroom, CASE WHEN order_total >= 300000 THEN 'high'
  WHEN order_total >= 100000 THEN 'medium' ELSE 'low' END AS tier
  FROM ord JOIN cust USING (customer_id) WHERE order_status = 'delivered'""")
def df_chain(m):
    people = m.customers().select("customer_id", "customer_name", "country", "balance")
    total = F.col("order_total")
    return (
        m.orders("delivered")
        .join(people, "customer_id")
        .withColumn("headroom", r2(total - F.col("balance")))
        .withColumn("tier", F.when(total >= 300000, "high").when(total >= 100000, "medium").otherwise("low"))
        .select("order_id", "customer_name", "country", "order_total", "created_at", "headroom", "tier")
        .sort(F.desc("order_total"), "order_id")
    )


@query("profile_customers", """SELECT customer_id, customer_name || ' (' || segment || ')' AS full_name,
  country || ', ' || region AS location, CASE WHEN balance >= 5000 THEN 'premium' WHEN balance >= 0 THEN 'standard'
  ELSE 'overdrawn' END AS class, country_customers FROM cust
  JOIN (SELECT country AS n, count(*) AS country_customers FROM cust GROUP BY country HAVING count(*) > 5) ON n = country""")
def profile_customers(m):
    # Counting countries by nation key needs 25 groups, so no customer is shuffled.
    c = m.customers()
    sizes = c.groupBy("country").agg(rows().alias("country_customers"))
    # Grouped by country, one row per row of the 25-row nation table.
    sizes = F.broadcast(sizes.filter(F.col("country_customers") > 5))
    balance = F.col("balance")
    return c.join(sizes, "country").select(
        "customer_id",
        F.concat("customer_name", F.lit(" ("), "segment", F.lit(")")).alias("full_name"),
        F.concat_ws(", ", "country", "region").alias("location"),
        F.when(balance >= 5000, "premium").when(balance >= 0, "standard").otherwise("overdrawn").alias("class"),
        "country_customers",
    )


# --- schema change -----------------------------------------------------------


@query("evolve_add_columns", """SELECT supplier_id, supplier_name, balance, FALSE AS is_preferred,
  CASE WHEN balance >= 7500 THEN 'strong' WHEN balance >= 2500 THEN 'fair' ELSE 'weak' END AS standing FROM supp""")
def evolve_add_columns(m):
    s = m.suppliers().select("supplier_id", "supplier_name", "balance")
    s = evolve.add_columns(s, {"is_preferred": ("boolean", False), "standing": ("string", None)})
    b = F.col("balance")
    return evolve.backfill(
        s, "standing", F.when(b >= 7500, "strong").when(b >= 2500, "fair").otherwise("weak")
    )


@query("evolve_rename_drop", "SELECT supplier_id, supplier_name AS legal_name, country AS home FROM supp")
def evolve_rename_drop(m):
    return evolve.rename(m.suppliers(), {"supplier_name": "legal_name", "country": "home"}).drop("region", "balance")


@query("evolve_widen", """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_orderkey, l_quantity
  FROM lineitem""")
def evolve_widen(m):
    t = m.table("lineitem").select("l_linenumber", "l_orderkey", "l_quantity")
    return evolve.widen(t, {"l_linenumber": "bigint"})


@query("evolve_retype_audited", f"""SELECT product_id, TRY_CAST(raw_size AS BIGINT) AS raw_size,
  CASE WHEN raw_size IS NOT NULL AND TRY_CAST(raw_size AS BIGINT) IS NULL THEN raw_size END AS rejected
  FROM (SELECT product_id, {RAW_SIZE} AS raw_size FROM prod)""")
def evolve_retype_audited(m):
    return evolve.retype(raw_sizes(m), "raw_size", "bigint")


@query("surrogate_keys", """SELECT customer_id, customer_name, row_number() OVER (ORDER BY customer_name, customer_id)
  + 999 AS customer_key FROM cust""")
def surrogate_keys(m):
    c = m.customers().select("customer_id", "customer_name")
    return dense_ids(c, [Order("customer_name"), Order("customer_id")], "customer_key", start=1000)


# --- scalar functions ----------------------------------------------------------


@query("string_clean", """SELECT supplier_id, upper(country) AS up, lower(supplier_name) AS low,
  length(supplier_name) AS size, trim('  ' || supplier_name || ' ') AS trimmed, left(supplier_name, 10) AS head,
  right(supplier_name, 5) AS tail, substr(supplier_name, 3, 4) AS middle, replace(supplier_name, 'Supplier', 'Vendor')
  AS replaced, split_part(supplier_name, '#', 2) AS digits FROM supp""")
def string_clean(m):
    name = F.col("supplier_name")
    return m.suppliers().select(
        "supplier_id",
        F.upper("country").alias("up"),
        F.lower(name).alias("low"),
        F.length(name).cast("bigint").alias("size"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.left(name, F.lit(10)).alias("head"),
        F.right(name, F.lit(5)).alias("tail"),
        F.substr(name, F.lit(3), F.lit(4)).alias("middle"),
        F.replace(name, F.lit("Supplier"), F.lit("Vendor")).alias("replaced"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("digits"),
    )


@query("string_concat", """SELECT customer_id, customer_name || ' / ' || nullif(segment, 'BUILDING') AS strict,
  concat_ws(' / ', customer_name, nullif(segment, 'BUILDING'), country) AS lenient FROM cust""")
def string_concat(m):
    segment = F.nullif(F.col("segment"), F.lit("BUILDING"))
    return m.customers().select(
        "customer_id",
        F.concat("customer_name", F.lit(" / "), segment).alias("strict"),
        F.concat_ws(" / ", "customer_name", segment, "country").alias("lenient"),
    )


@query("regex_validate", f"SELECT customer_id, email, regexp_full_match(email, '{EMAIL}') AS is_valid FROM cust")
def regex_validate(m):
    return m.customers().select("customer_id", "email", F.col("email").rlike(EMAIL).alias("is_valid"))


@query("repeat_pad", """SELECT order_id, repeat('*', CAST(substr(shipping_method, 1, 1) AS INTEGER)) AS stars,
  greatest(order_total, 100000.0e0) AS at_least, least(order_total, 100000.0e0) AS at_most FROM ord""")
def repeat_pad(m):
    urgency = F.substring("shipping_method", 1, 1).cast("int")
    return m.orders().select(
        "order_id",
        F.repeat(F.lit("*"), urgency).alias("stars"),
        F.greatest("order_total", F.lit(100000.0)).alias("at_least"),
        F.least("order_total", F.lit(100000.0)).alias("at_most"),
    )


@query("date_parts", f"""SELECT order_id, year(created_at) AS y, month(created_at) AS mo, day(created_at) AS d,
  {q.month('created_at')} AS month_start, CAST(created_at AS DATE) + 30 AS due,
  date_diff('day', DATE '1995-01-01', CAST(created_at AS DATE)) AS day_no FROM ord""")
def date_parts(m):
    at = F.col("created_at")
    return m.orders().select(
        "order_id",
        F.year(at).cast("bigint").alias("y"),
        F.month(at).cast("bigint").alias("mo"),
        F.day(at).cast("bigint").alias("d"),
        month(at).alias("month_start"),
        F.date_add(at.cast("date"), 30).alias("due"),
        F.datediff(at.cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("day_no"),
    )


@query("iso_week", f"""SELECT CAST(date_trunc('week', created_at) AS TIMESTAMP) AS week_start,
  week(created_at) AS iso_week, count(*) AS orders, {q.money('order_total')} AS revenue FROM ord GROUP BY ALL""")
def iso_week(m):
    week = F.date_trunc("week", "created_at").cast("timestamp_ntz")
    o = m.orders().groupBy(week.alias("week_start")).agg(rows().alias("orders"), money("order_total").alias("revenue"))
    return o.withColumn("iso_week", F.weekofyear("week_start").cast("bigint"))


@query("timezone_convert", """SELECT event_id, created_at - INTERVAL 5 HOUR AS new_york,
  created_at + INTERVAL 9 HOUR AS tokyo FROM click""")
def timezone_convert(m):
    """The stored month has no clock change, so the oracle may use fixed offsets."""
    there = lambda zone: F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("created_at"))
    return m.clicks().select(
        "event_id", there("America/New_York").alias("new_york"), there("Asia/Tokyo").alias("tokyo")
    )


@query("date_formats", """SELECT order_id, strftime(created_at, '%d/%m/%Y') AS european,
  strftime(created_at, '%m-%d-%y') AS american, CAST(strptime(strftime(created_at, '%d/%m/%Y'), '%d/%m/%Y') AS DATE)
  AS parsed FROM ord""")
def date_formats(m):
    european = F.date_format("created_at", "dd/MM/yyyy")
    return m.orders().select(
        "order_id",
        european.alias("european"),
        F.date_format("created_at", "MM-dd-yy").alias("american"),
        F.to_date(european, "dd/MM/yyyy").alias("parsed"),
    )


@query("numeric", """SELECT order_id, round(order_total, 0) AS whole, power(CAST(substr(shipping_method, 1, 1)
  AS DOUBLE), 3) AS cubed, CAST(round(CAST(order_total AS DECIMAL(38,4)) / power(1024, 2), 4) AS DOUBLE) AS mega FROM ord""")
def numeric(m):
    total = F.col("order_total")
    return m.orders().select(
        "order_id",
        F.round(total, 0).alias("whole"),
        F.pow(F.substring("shipping_method", 1, 1).cast("double"), F.lit(3.0)).alias("cubed"),
        F.round(total / F.pow(F.lit(1024.0), F.lit(2.0)), 4).alias("mega"),
    )


@query("random_fill")
def random_fill(m):
    fill = (F.rand(seed=3) * 90 + 10).cast("bigint")
    return m.suppliers().select("supplier_id", fill.alias("score"))


@query("conditional", """SELECT order_id, CASE WHEN nullif(shipping_method, '5-LOW') IS NOT NULL THEN 'set' ELSE 'unset' END
  AS has_method, CASE order_status WHEN 'delivered' THEN 'done' WHEN 'shipped' THEN 'moving' ELSE 'open' END AS stage,
  CASE WHEN order_total > 250000 AND order_status = 'placed' THEN 1 ELSE 0 END AS watch FROM ord""")
def conditional(m):
    method = F.nullif(F.col("shipping_method"), F.lit("5-LOW"))
    return m.orders().select(
        "order_id",
        F.nvl2(method, F.lit("set"), F.lit("unset")).alias("has_method"),
        F.expr("decode(order_status, 'delivered', 'done', 'shipped', 'moving', 'open')").alias("stage"),
        F.when((F.col("order_total") > 250000) & (F.col("order_status") == "placed"), 1).otherwise(0).alias("watch"),
    )


# --- set operations --------------------------------------------------------------


@query("union_all_sources", f"""SELECT party, region, count(*) AS members, {q.money('balance')} AS balance,
  count(segment) AS with_segment FROM (SELECT 'customer' AS party, region, balance, segment FROM cust
  UNION ALL SELECT 'supplier', region, balance, NULL FROM supp) GROUP BY party, region""")
def union_all_sources(m):
    c = m.customers().select(F.lit("customer").alias("party"), "region", "balance", "segment")
    s = m.suppliers().select(F.lit("supplier").alias("party"), "region", "balance")
    both = c.unionByName(s, allowMissingColumns=True)
    return both.groupBy("party", "region").agg(
        rows().alias("members"), money("balance").alias("balance"), F.count("segment").alias("with_segment")
    )


@query("union_two_measures", f"""SELECT 'order headers' AS measured_on, max(created_at) AS as_of,
  {q.money('order_total')} AS amount FROM ord UNION ALL
  SELECT 'order items', max(shipped_at), {q.money('line_total')} FROM item""")
def union_two_measures(m):
    heads = m.orders().agg(F.max("created_at").alias("as_of"), money("order_total").alias("amount"))
    lines = m.items().agg(F.max("shipped_at").alias("as_of"), money("line_total").alias("amount"))
    return heads.select(F.lit("order headers").alias("measured_on"), "as_of", "amount").unionAll(
        lines.select(F.lit("order items").alias("measured_on"), "as_of", "amount")
    )


@query("except_rows", """SELECT customer_id FROM ord WHERE order_status = 'delivered'
  EXCEPT SELECT customer_id FROM ord WHERE order_status = 'placed'""")
def except_rows(m):
    # Distinct first: a customer with very many orders is one row per task.
    buyers = lambda status: m.orders(status).select("customer_id").distinct()
    return buyers("delivered").subtract(buyers("placed"))
