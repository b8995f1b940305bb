"""The commerce entities, each a projection over the stored tables.

Attributes the stored tables lack (cost, rating, device, anonymous visitors) are
computed from keys; no row is dropped for it.  Status filters are given to the
entity function, which applies them to the stored code, so that they reach the
Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.session import tune

# Order status by stored code, device by position.
STATUS = {"F": "delivered", "O": "shipped", "P": "placed"}
DEVICES = ["desktop", "mobile", "tablet"]

# Scans of fewer splits than this (2 GB at the default split size) are short.
SHORT_SCAN = 16
# Rows of a short scan dealt to one task at most, if no value is frequent.
DEALT_ROWS = 500_000


class Model:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = tune(spark)
        self.path = path.rstrip("/")
        # Schema, number of scan tasks and rows, found out once a query: it costs a job.
        self._schemas: dict[str, T.StructType] = {}
        self._splits: dict[str, int] = {}
        self._rows: dict[str, int] = {}

    def table(self, name: str, deal_by: str | None = None) -> DataFrame:
        """A stored table.

        A file of few row groups is read by few tasks, and all work up to the next
        shuffle runs in them.  With ``deal_by`` the rows of such a short scan are dealt
        over the cores by a column, which later joins and groupings by it reuse.  Only
        scans of a few splits are dealt, so that a very frequent value costs no more
        than the short scan itself would; larger tables are left alone.  Few splits may
        still hold very many rows, and groupings by the column work on what one task was
        dealt, so the number of tasks grows with the rows (counted from the file footers).
        """
        path = f"{self.path}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(self._schemas[path]).parquet(path)
        if deal_by is None:
            return df
        cores = self.spark.sparkContext.defaultParallelism
        if path not in self._splits:
            self._splits[path] = df.rdd.getNumPartitions()
        if self._splits[path] >= SHORT_SCAN:
            return df
        if path not in self._rows:
            self._rows[path] = df.count()
        tasks = max(min(cores, SHORT_SCAN), -(-self._rows[path] // DEALT_ROWS))
        return df.repartition(tasks, deal_by)

    def geography(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region")
        )

    def customers(self) -> DataFrame:
        name = F.col("c_name")
        digits = lambda start, size: F.substring(name, start, size)
        c = self.table("customer").join(self.geography(), F.col("c_nationkey") == F.col("n_nationkey"))
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            name.alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            "country",
            "region",
            F.col("c_acctbal").alias("balance"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
            F.concat(
                F.lower(F.replace(name, F.lit("#"), F.lit("."))),
                F.when(F.col("c_acctbal") >= 0, "@").otherwise(" at "),
                F.initcap("c_mktsegment"),
                F.lit(".example.com"),
            ).alias("email"),
            F.concat(digits(10, 3), F.lit("-"), digits(13, 3), F.lit("-0"), digits(16, 3)).alias("phone"),
        )

    def orders(self, *statuses: str, deal: bool = False) -> DataFrame:
        o = self.table("orders", deal_by="o_orderkey" if deal else None)
        if statuses:
            codes = [code for code, label in STATUS.items() if label in statuses]
            o = o.filter(F.col("o_orderstatus").isin(codes))
        label = F.lit(None).cast("string")
        for code, text in STATUS.items():
            label = F.when(F.col("o_orderstatus") == code, text).otherwise(label)
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            label.alias("order_status"),
            F.col("o_totalprice").alias("order_total"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderpriority").alias("shipping_method"),
        )

    def items(self, deal: bool = True) -> DataFrame:
        return self.table("lineitem", deal_by="l_orderkey" if deal else None).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("gross"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_total"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").alias("shipped_at"),
        )

    def returns(self) -> DataFrame:
        r = self.items().filter(F.col("return_flag") == "R")
        return r.withColumn("refund", 0.9 * F.col("line_total"))

    def products(self) -> DataFrame:
        band = (3500 + 30 * (F.col("p_partkey") % 100)).cast("double")
        suppliers = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.col("p_size").cast("bigint").alias("size"),
            F.col("p_retailprice").alias("unit_price"),
            (F.col("p_retailprice") * band / F.lit(10000.0)).alias("cost_price"),
            (F.col("p_partkey") % suppliers).alias("supplier_id"),
        )

    def suppliers(self) -> DataFrame:
        s = self.table("supplier").join(self.geography(), F.col("s_nationkey") == F.col("n_nationkey"))
        return s.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            "country",
            "region",
            F.col("s_acctbal").alias("balance"),
        )

    def reviews(self) -> DataFrame:
        products = self.table("part").agg(F.count(F.lit(1))).scalar()
        # Scoring text is the expensive part, so it should use every core.
        return self.table("documents", deal_by="doc_id").select(
            F.col("doc_id").alias("review_id"),
            (F.col("doc_id") % products).alias("product_id"),
            (1 + F.col("doc_id") % 5).alias("rating"),
            F.col("text").alias("review_text"),
            F.col("lang"),
            F.col("source"),
            F.col("n_chars").alias("helpful_votes"),
        )

    def review_labels(self) -> DataFrame:
        return self.table("labels").select(
            F.col("doc_id").alias("review_id"), F.col("quality").cast("bigint"), F.col("toxic").cast("bigint")
        )

    def clicks(self, deal: bool = False) -> DataFrame:
        device = F.element_at(
            F.array(*[F.lit(d) for d in DEVICES]), (1 + F.col("event_id") % 3).cast("int")
        )
        return self.table("events", deal_by="event_id" if deal else None).select(
            "event_id",
            F.when(F.col("event_id") % 6 != 0, F.col("user_id")).alias("customer_id"),
            F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
            "event_type",
            device.alias("device"),
            "value",
            "props",
            F.col("ts").alias("created_at"),
        )

    def usage(self) -> DataFrame:
        """Click events read as a metering log: one row per metered action."""
        return self.table("events").select(
            F.col("event_id").alias("query_id"),
            F.col("ts").alias("start_time"),
            F.col("event_type").alias("resource"),
            F.col("value").alias("credits"),
            F.concat(F.lit("team-"), F.col("user_id").cast("string")).alias("query_tag"),
            F.col("user_id"),
            "props",
        )
