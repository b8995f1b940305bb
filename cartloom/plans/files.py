"""File loading and unloading.

Each query writes files from the stored tables to the shared scratch folder and
answers from what it reads back, so the oracle can ask the stored tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import mean, money, rows
from cartloom.operators.groups import Order
from cartloom.plans import oracle as q
from cartloom.plans.projection import RAW_SIZE, raw_sizes
from cartloom.plans.registry import query
from cartloom.session import scratch
from cartloom.sources import loading, readers, writers
from cartloom.sources.ledger import Ledger, load_folder, loaded_rows
from cartloom.sources.readers import CsvFormat

ORDER_DDL = "order_id bigint, customer_id bigint, order_status string, order_total double, created_at timestamp_ntz, shipping_method string"


def orders_csv(m, label, sep=","):
    """Orders as CSV parts in which placed orders have an 'N/A' total."""
    path = scratch(m.spark, label)
    total = F.when(F.col("order_status") == "placed", "N/A").otherwise(F.col("order_total").cast("string"))
    o = m.orders(deal=True).withColumns({"order_total": total, "created_at": F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")})
    writers.csv_parts(o, path, sep=sep)
    return path


ORDERS_BACK = """SELECT order_id, customer_id, order_status, CASE WHEN order_status <> 'placed' THEN order_total END AS order_total,
  created_at, shipping_method FROM ord"""


@query("csv_load_typed", ORDERS_BACK)
def csv_load_typed(m):
    fmt = CsvFormat(timestamp_format="yyyy-MM-dd HH:mm:ss")
    return readers.csv_typed(m.spark, orders_csv(m, "typed"), ORDER_DDL, fmt)


@query("csv_dialects", ORDERS_BACK)
def csv_dialects(m):
    """Pipe-separated, gzip parts."""
    return readers.csv_typed(m.spark, orders_csv(m, "pipe", "|"), ORDER_DDL, CsvFormat(sep="|"))


@query("csv_charset_crlf", """SELECT order_id, customer_id, order_status, CASE WHEN order_status <> 'placed' THEN order_total END
  AS order_total, created_at, 'Exprès ' || shipping_method AS shipping_method FROM ord""")
def csv_charset_crlf(m):
    """Latin-1 text with CRLF line ends and quoted fields."""
    path = scratch(m.spark, "latin")
    text = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    o = m.orders(deal=True).withColumns({"created_at": text, "shipping_method": F.concat(F.lit("Exprès "), "shipping_method")})
    o = o.withColumn("order_total", F.when(F.col("order_status") != "placed", F.col("order_total")))
    fmt = CsvFormat(sep=";", encoding="ISO-8859-1", line_sep="\r\n", timestamp_format="yyyy-MM-dd HH:mm:ss")
    o.write.options(**fmt.options()).option("quoteAll", True).option("header", True).csv(path)
    return readers.csv_typed(m.spark, path, ORDER_DDL, fmt)


@query("json_array_load", "SELECT event_id, event_type, device, value FROM click")
def json_array_load(m):
    path = scratch(m.spark, "arrays")
    c = m.clicks().select("event_id", "event_type", "device", "value")
    writers.json_arrays(c, path, [Order("event_id")], rows_per_array=100_000)
    return typed_events(readers.json_arrays(m.spark, path))


def typed_events(docs):
    at = lambda name, kind: F.variant_get("doc", f"$.{name}", kind).alias(name)
    return docs.select(at("event_id", "bigint"), at("event_type", "string"), at("device", "string"), at("value", "double"))


@query("ndjson_load", "SELECT event_id, event_type, device, value FROM click")
def ndjson_load(m):
    path = scratch(m.spark, "lines")
    writers.json_lines(m.clicks().select("event_id", "event_type", "device", "value"), path)
    return typed_events(readers.json_lines(m.spark, path))


@query("parquet_load_by_name", "SELECT product_id, category, unit_price, CAST(NULL AS VARCHAR) AS note FROM prod")
def parquet_load_by_name(m):
    """Files with other case, other order and more columns than asked for."""
    path = scratch(m.spark, "parquet")
    p = m.products().select(F.col("unit_price").alias("UNIT_PRICE"), "size", F.col("category").alias("Category"), "product_id")
    p.write.parquet(path)
    return readers.parquet_by_name(m.spark, path, "product_id bigint, category string, unit_price double, note string")


@query("epoch_to_timestamp", """SELECT event_id, created_at AS from_micros, date_trunc('millisecond', created_at) AS from_millis,
  CAST(date_trunc('second', created_at) AS TIMESTAMP) AS from_seconds FROM click""")
def epoch_to_timestamp(m):
    us = F.unix_micros(F.col("created_at").cast("timestamp"))
    c = m.clicks().select("event_id", us.alias("us"))
    whole = lambda n: F.floor(F.col("us") / n)
    return c.select(
        "event_id",
        readers.epoch_timestamp(F.col("us"), 6).alias("from_micros"),
        readers.epoch_timestamp(F.expr("us div 1000"), 3).alias("from_millis"),
        readers.epoch_timestamp(F.expr("us div 1000000"), 0).alias("from_seconds"),
    )


@query("orc_xml_load", """SELECT 'orc' AS source, supplier_id, supplier_name, balance FROM supp
  UNION ALL SELECT 'xml', supplier_id, supplier_name, balance FROM supp""")
def orc_xml_load(m):
    s = m.suppliers().select("supplier_id", "supplier_name", "balance")
    orc, xml = scratch(m.spark, "orc"), scratch(m.spark, "xml")
    s.write.orc(orc)
    s.write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(xml)
    a = readers.orc(m.spark, orc).withColumn("source", F.lit("orc"))
    b = readers.xml(m.spark, xml, "supplier", s.schema).withColumn("source", F.lit("xml"))
    return a.unionByName(b)


@query("file_query_positional", """SELECT shipping_method, count(*) AS orders, round(sum(CASE WHEN order_status <> 'placed'
  THEN order_total END), 2) AS total FROM ord GROUP BY shipping_method""")
def file_query_positional(m):
    raw = readers.csv_positional(
        m.spark, orders_csv(m, "positional"), {6: ("shipping_method", "string"), 4: ("order_total", "double")}
    )
    return raw.groupBy("shipping_method").agg(rows().alias("orders"), F.round(F.sum("order_total"), 2).alias("total"))


@query("file_join_table", """SELECT segment, count(*) AS orders FROM ord JOIN cust USING (customer_id) GROUP BY segment""")
def file_join_table(m):
    raw = readers.csv_typed(m.spark, orders_csv(m, "join"), "customer_id bigint")
    return raw.join(m.customers().select("customer_id", "segment"), "customer_id").groupBy("segment").agg(rows().alias("orders"))


@query("file_lineage_counts", "SELECT order_status AS folder, count(*) AS rows FROM ord GROUP BY 1")
def file_lineage_counts(m):
    """Rows per source, from the path of the file each row came from."""
    path = scratch(m.spark, "lineage")
    writers.partitioned(m.orders(), path, ["order_status"])
    folder = F.regexp_extract("_metadata.file_path", "order_status=([a-z]+)/", 1)
    files = m.spark.read.option("pathGlobFilter", "part-*.parquet").parquet(path)
    return files.select(folder.alias("folder")).groupBy("folder").agg(rows().alias("rows"))


@query("load_with_transform", """SELECT order_id, upper(order_status) AS order_status, CAST(created_at AS DATE) AS day,
  CASE WHEN order_status <> 'placed' THEN order_total * 2 END AS doubled, 'import' AS channel FROM ord""")
def load_with_transform(m):
    """Columns reshaped on the way in; a column the file lacks takes its default."""
    raw = readers.csv_typed(m.spark, orders_csv(m, "transform"), ORDER_DDL)
    return writers.create_table_as(
        raw.select(
            "order_id",
            F.upper("order_status").alias("order_status"),
            F.col("created_at").cast("date").alias("day"),
            (F.col("order_total") * 2).alias("doubled"),
            F.lit("import").alias("channel"),
        ),
        scratch(m.spark, "loaded"),
    )


SIZE_DDL = "product_id bigint, raw_size bigint"


def checked_sizes(m):
    path = scratch(m.spark, "sizes")
    writers.csv_parts(raw_sizes(m), path, compression="none")
    return loading.checked(m.spark, path, SIZE_DDL)


SIZES = f"(SELECT product_id, {RAW_SIZE} AS raw_size, TRY_CAST({RAW_SIZE} AS BIGINT) AS size FROM (SELECT product_id, size, subcategory FROM prod))"


@query("load_validate", f"""SELECT 'raw_size' AS "column", 'bigint' AS "type", raw_size AS value, '''' || raw_size ||
  ''' is not a valid bigint' AS message, count(*) AS cells FROM {SIZES} WHERE size IS NULL GROUP BY ALL""")
def load_validate(m):
    cells = loading.bad_cells(checked_sizes(m))
    return cells.groupBy("column", "type", "value", "message").agg(rows().alias("cells"))


@query("load_on_error", f"SELECT product_id, size AS raw_size FROM {SIZES} WHERE size IS NOT NULL")
def load_on_error(m):
    return loading.load(checked_sizes(m), loading.OnError.CONTINUE)


@query("load_abort", f"""SELECT CAST(count(*) AS BIGINT) AS rows_parsed, CAST(0 AS BIGINT) AS rows_loaded, count(*) - count(size) AS
  error_count, 'LOAD_FAILED' AS status, true AS refused FROM {SIZES}""")
def load_abort(m):
    """One bad cell stops the load: nothing goes in, clean files included, and the history says so."""
    records = checked_sizes(m)
    refused = False
    try:
        loading.load(records, loading.OnError.ABORT)
    except loading.LoadError:
        refused = True
    h = loading.history(records, loading.OnError.ABORT).groupBy("status")
    sums = h.agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "error_count")])
    return sums.withColumn("refused", F.lit(refused))


@query("load_skip_file", """SELECT product_id, CAST(size AS BIGINT) AS raw_size FROM (SELECT product_id, size, count(*) FILTER (WHERE
  size > 25) OVER (PARTITION BY size // 10, product_id % 32) AS bad FROM prod) WHERE bad = 0""")
def load_skip_file(m):
    """Products in files by size: a file with one bad cell is left out whole, its good rows too."""
    path = scratch(m.spark, "skipped")
    decade, part = F.floor(F.col("size") / 10).alias("decade"), (F.col("product_id") % 32).alias("part")
    sizes = raw_sizes(m, decade, part).repartition("decade", "part")  # one file a folder
    sizes.write.partitionBy("decade", "part").option("header", True).csv(path)
    records = loading.checked(m.spark, f"{path}/*/*", SIZE_DDL)
    return loading.load(records, loading.OnError.SKIP_FILE)


@query("load_history", f"""SELECT CAST(count(*) AS BIGINT) AS rows_parsed, count(size) AS rows_loaded, count(*) - count(size) AS error_count,
  'PARTIALLY_LOADED' AS status FROM {SIZES}""")
def load_history(m):
    h = loading.history(checked_sizes(m), loading.OnError.CONTINUE)
    return h.groupBy("status").agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "error_count")])


@query("load_dedup", """SELECT order_status, count(*) AS rows, round(sum(order_total), 2) AS total FROM ord GROUP BY 1""")
def load_dedup(m):
    """Three loads of a growing folder: each takes up only files that no load took in as
    they are, and the last one finds none."""
    folder, table = scratch(m.spark, "inbox"), scratch(m.spark, "table")
    books = Ledger(m.spark, scratch(m.spark, "ledger"))
    for statuses in (["delivered"], ["shipped", "placed"], []):
        if statuses:
            m.orders(*statuses).write.mode("append").option("header", True).csv(folder)
        load_folder(books, folder, table, ORDER_DDL, pattern="*.csv")
    return loaded_rows(books, table).groupBy("order_status").agg(
        rows().alias("rows"), F.round(F.sum("order_total"), 2).alias("total")
    )


# --- unloading -----------------------------------------------------------------------


@query("unload_csv", "SELECT order_id, order_total FROM ord ORDER BY order_total DESC, order_id LIMIT 1000")
def unload_csv(m):
    path = scratch(m.spark, "export")
    o = m.orders().select("order_id", "order_total")
    writers.single_csv(o, path, [Order("order_total", True), Order("order_id")], 1000, sep="|")
    return readers.csv_typed(m.spark, path, "order_id bigint, order_total double", CsvFormat(sep="|"))


@query("unload_parts", "SELECT order_id, order_status, order_total FROM ord")
def unload_parts(m):
    path = scratch(m.spark, "parts")
    writers.csv_parts(m.orders().select("order_id", "order_status", "order_total"), path, rows_per_file=4000)
    return readers.csv_typed(m.spark, path, "order_id bigint, order_status string, order_total double")


@query("unload_json", "SELECT review_id, rating, helpful_votes, quality FROM rev LEFT JOIN labels ON review_id = doc_id")
def unload_json(m):
    path = scratch(m.spark, "json")
    r = m.reviews().select("review_id", "rating", "helpful_votes").join(m.review_labels().select("review_id", "quality"), "review_id", "left")
    writers.json_lines(r, path)
    back = m.spark.read.schema("review_id bigint, rating bigint, helpful_votes bigint, quality int").json(path)
    return back


@query("unload_partitioned", f"""SELECT CAST(year(created_at) AS INTEGER) AS order_year, count(*) AS orders, {q.money('order_total')} AS
  revenue FROM ord GROUP BY 1""")
def unload_partitioned(m):
    path = scratch(m.spark, "by-year")
    writers.partitioned(m.orders().withColumn("order_year", F.year("created_at")), path, ["order_year"])
    return m.spark.read.parquet(path).groupBy("order_year").agg(rows().alias("orders"), money("order_total").alias("revenue"))


@query("unload_by_rating", """SELECT CAST(rating AS INTEGER) AS rating, count(*) AS reviews, CAST(sum(helpful_votes) AS BIGINT)
  AS votes FROM rev GROUP BY 1""")
def unload_by_rating(m):
    path = scratch(m.spark, "by-rating")
    writers.partitioned(m.reviews(), path, ["rating"], fmt="json")
    back = m.spark.read.schema("review_id bigint, helpful_votes bigint, rating int").json(path)
    return back.groupBy("rating").agg(rows().alias("reviews"), F.sum("helpful_votes").alias("votes"))


@query("create_table_as", f"""SELECT category, count(*) AS products, {q.mean('unit_price')} AS avg_price FROM prod GROUP BY category
  UNION ALL SELECT 'all', count(*), {q.mean('unit_price')} FROM prod""")
def create_table_as(m):
    """Create, then append to, a persisted summary."""
    path = scratch(m.spark, "summary")
    p = m.products()
    per = p.groupBy("category").agg(rows().alias("products"), mean("unit_price").alias("avg_price"))
    writers.create_table_as(per, path)
    whole = p.agg(rows().alias("products"), mean("unit_price").alias("avg_price"))
    return writers.create_table_as(whole.select(F.lit("all").alias("category"), "products", "avg_price"), path, "append")


@query("format_parity", f"""SELECT category, {q.mean('rating')} AS avg_rating, count(*) AS reviews, CAST(0 AS BIGINT) AS mismatches
  FROM rev JOIN prod USING (product_id) GROUP BY category""")
def format_parity(m):
    """The same reviews through CSV, JSON and Parquet give the same averages."""
    r = m.reviews().select("review_id", "rating", "product_id").join(m.products().select("product_id", "category"), "product_id")
    csv, lines, parquet = (scratch(m.spark, x) for x in ("p-csv", "p-json", "p-parquet"))
    writers.csv_parts(r, csv)
    writers.json_lines(r, lines)
    r.write.parquet(parquet)
    get = lambda name, kind: F.variant_get("doc", f"$.{name}", kind).alias(name)
    loaded = [
        readers.csv_typed(m.spark, csv, "rating bigint, category string"),
        readers.json_lines(m.spark, lines).select(get("rating", "bigint"), get("category", "string")),
        readers.parquet_by_name(m.spark, parquet, "rating bigint, category string"),
    ]
    by = [d.groupBy("category").agg(mean("rating").alias("avg_rating"), rows().alias("reviews")) for d in loaded]
    apart = None
    for other in by[1:]:
        diff = by[0].exceptAll(other).unionAll(other.exceptAll(by[0]))
        apart = diff if apart is None else apart.unionAll(diff)
    return by[0].withColumn("mismatches", apart.agg(rows()).scalar())
