"""Data-quality checks and row routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str, issue: str, record: Column) -> DataFrame:
    """Child rows whose ``key`` has no parent, as (issue_type, rows, first_record).

    Children are counted per key before the anti join, so a key with very many
    rows is a few partial counts.  A child without a key is no orphan.
    """
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min(record).alias("first_record"))
    missing = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return missing.select(F.lit(issue).alias("issue_type"), "rows", "first_record")


def violations(df: DataFrame, test: Column, issue: str, record: Column) -> DataFrame:
    """Rows that fail a test on their own columns, in the same form."""
    return df.filter(test).select(
        F.lit(issue).alias("issue_type"), F.lit(1).cast("bigint").alias("rows"), record.alias("first_record")
    )


def report(checks: list[DataFrame]) -> DataFrame:
    """Issues per type; no row means clean data."""
    found = reduce(DataFrame.unionByName, checks)
    return found.groupBy("issue_type").agg(
        F.sum("rows").alias("issues"), F.min("first_record").alias("first_record")
    )


def with_reason(df: DataFrame, rules: list[tuple[Column, str]], out: str = "reason") -> DataFrame:
    """Tag each row with the first rule it breaks, NULL when it breaks none."""
    reason = F.lit(None).cast("string")
    for test, text in reversed(rules):
        reason = F.when(F.coalesce(test, F.lit(False)), text).otherwise(reason)
    return df.withColumn(out, reason)


def route(df: DataFrame, rules: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reason)."""
    tagged = with_reason(df, rules)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())
