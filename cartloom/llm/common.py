"""What several operators of this subpackage share: tables, batches, joins with very large keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.session import durable, tune

#: At most this many keys are treated as heavy, whatever the size of the input.
HEAVY_KEYS = 4096

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of the keys in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, how: str = "left", total: int | None = None) -> DataFrame:
    """Join ``facts`` (one row per key) to ``rows`` although a key may hold a third of them.

    ``weight`` counts the rows of a key in ``rows``. Keys above 1/HEAVY_KEYS of the
    total weight number fewer than HEAVY_KEYS whatever the input, so their facts are
    broadcast; every other key is too small to make a task stand out and is joined by
    shuffle. Both inputs are read twice, so they should be stored. NULL keys match NULL
    keys. The weight column is not returned. ``total`` saves the sum where the number of
    rows is known.
    """
    if total is None:
        total = facts.agg(F.sum(weight)).first()[0] or 0
    bar = total // HEAVY_KEYS
    values = [c for c in facts.columns if c not in (*keys, weight)]
    renamed = facts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *values, weight)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    out = [*rows.columns, *values]
    heavy = renamed.where(F.col(weight) > bar).drop(weight)
    light = renamed.where(F.col(weight) <= bar).drop(weight)
    hot = rows.join(F.broadcast(heavy), on, "inner").select(*out)
    bare = heavy.select(*[f"_k{i}" for i in range(len(keys))])
    rest = rows.join(F.broadcast(bare), on, "left_anti").join(light, on, how).select(*out)
    return hot.unionByName(rest)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has one of them in any letter case."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def once(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """One row of each key, the one with the least hash of all its columns; a task hands on one row a key."""
    (place,) = fresh(df, "_place")
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*[df[c] for c in df.columns]))
    return df.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


__all__ = [
    "HEAVY_KEYS", "ORACLE", "QUERIES", "attach", "by_batch", "durable", "fresh", "lower_ascii", "once", "query", "same", "table", "tune",
]
