"""Query registry: a Spark plan and, where SQL can say it, its oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartloom.model import Model
from cartloom.plans.oracle import with_entities

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(model) -> DataFrame`` under ``key``."""

    def register(fn: Callable[[Model], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, path: str) -> DataFrame:
            return fn(Model(spark, path))

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = with_entities(sql)
        return fn

    return register
