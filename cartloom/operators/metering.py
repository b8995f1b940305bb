"""Questions over usage and cost logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.groups import Neighbour, Order, Running, find_hot, in_order

MINIMUM_SECONDS = 60


def sessions(
    log: DataFrame, key: str, at: str, tie: str, idle_seconds: int, hot_rows: int | None = None
) -> DataFrame:
    """Running periods per key: a gap longer than ``idle_seconds`` ends one.

    Both passes sort by key and time; on one plan they share the shuffle.
    """
    order = [Order(at), Order(tie)]
    log = log.select(key, at, tie)
    hot = find_hot(log, [key], hot_rows)
    s = in_order(log, [key], order, [Neighbour("_before", at)], hot_rows, hot)
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp"))
    starts = F.when(F.col("_before").isNull() | (gap > idle_seconds * 1_000_000), 1).otherwise(0)
    s = s.withColumn("_start", starts.cast("bigint")).drop("_before")
    s = in_order(s, [key], order, [Running("session_no", "_start")], hot_rows, hot)
    return s.groupBy(key, "session_no").agg(
        F.min(at).alias("started_at"), F.max(at).alias("ended_at"), F.count(F.lit(1)).alias("actions")
    )


def billed(periods: DataFrame, size: Column) -> DataFrame:
    """Seconds billed, at least a minute per start, and credits: one per hour at size
    0, doubling with each size."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seconds = F.ceil((us("ended_at") - us("started_at")) / 1_000_000).cast("bigint")
    return periods.withColumn("billed_seconds", F.greatest(seconds, F.lit(MINIMUM_SECONDS).cast("bigint"))).withColumn(
        "credits", F.round(F.col("billed_seconds") * F.pow(F.lit(2.0), size) / 3600, 6)
    )


def quota_crossings(
    log: DataFrame, at: str, tie: str, value: str, quota: float, percents: Sequence[int], hot_rows: int | None = None
) -> DataFrame:
    """When each day's use first reached each share of the quota."""
    log = log.select(F.col(at).cast("date").alias("day"), at, tie, value)
    r = in_order(log, ["day"], [Order(at), Order(tie)], [Running("_used", value)], hot_rows)
    used = F.round("_used", 2)
    firsts = [F.min(F.when(used >= quota * p / 100, F.col(at))).alias(f"_{p}") for p in percents]
    per_day = r.groupBy("day").agg(*firsts)
    cells = F.array(
        *[F.struct(F.lit(p).cast("bigint").alias("pct"), F.col(f"_{p}").alias("crossed_at")) for p in percents]
    )
    return per_day.select("day", F.inline(cells)).filter(F.col("crossed_at").isNotNull())


def tumbling(df: DataFrame, at: str, width: str, by: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregates per fixed time slice; the same on a table and on a stream whose
    ``at`` carries a watermark."""
    stamped = df if dict(df.dtypes)[at] == "timestamp" else df.withColumn(at, F.col(at).cast("timestamp"))
    g = stamped.groupBy(F.window(at, width).alias("_w"), *by).agg(*aggs)
    start, end = F.col("_w.start").cast("timestamp_ntz"), F.col("_w.end").cast("timestamp_ntz")
    return g.withColumns({"slice_start": start, "slice_end": end}).drop("_w")
