"""Change feeds and rejected rows handled as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from cartloom.operators.buckets import BucketTable
from cartloom.operators.changes import apply_changes
from cartloom.operators.groups import Order
from cartloom.operators.quality import route
from cartloom.streaming.ingest import current, each_batch


def merge_stream(
    spark: SparkSession, feed: DataFrame, target: str, checkpoint: str, keys: Sequence[str], sequence: Sequence[Order]
) -> None:
    """Fold an arriving feed into a versioned table whose first version is 0.

    Batch n turns version n into version n + 1.  The offset moves only after the
    new version is written; a batch repeated after a failure starts from the same
    version and overwrites its own result.  Without new files no batch runs.  All
    files that wait are one batch, so a run rewrites the table once.
    """

    def fold(batch: DataFrame, number: int) -> None:
        before = spark.read.parquet(f"{target}/version={number}")
        after = apply_changes(before, batch, keys, sequence)
        after.write.mode("overwrite").parquet(f"{target}/version={number + 1}")

    each_batch(feed, checkpoint, fold)


def merge_buckets(feed: DataFrame, target: BucketTable, checkpoint: str, sequence: Sequence[Order], keep: int = 2) -> None:
    """Fold an arriving feed into a table of key buckets, whose version 0 exists.

    Batch n turns version n into version n + 1 and rewrites only the buckets that hold a
    key of the batch. A batch repeated after a failure starts from the same version and
    replaces its own parts. Versions other than the last ``keep`` are pruned.
    """

    def fold(batch: DataFrame, number: int) -> None:
        target.fold(batch, number, sequence)
        target.prune(keep)

    each_batch(feed, checkpoint, fold)


def latest_state(spark: SparkSession, target: str) -> DataFrame:
    return current(spark, target)


def split_stream(rows: DataFrame, rules: list[tuple[Column, str]], valid: str, rejected: str, checkpoint: str) -> None:
    """Valid rows to one place, rejected rows with a reason to another; both writes
    of a batch go to a folder of that batch, so a repeat replaces them."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # two writes, one read of the arriving files
        try:
            good, bad = route(batch, rules)
            good.write.mode("overwrite").parquet(f"{valid}/batch={number}")
            bad.write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        finally:
            batch.unpersist()

    each_batch(rows, checkpoint, write)
