"""Change feeds between table versions and table states from a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.groups import Order, newest
from cartloom.operators.rewrite import Clause, merge

DELETE, INSERT = "DELETE", "INSERT"


def _row_id(keys: Sequence[str]) -> Column:
    """A digest of the named key values, so that NULLs and neighbours are not mixed up."""
    return F.md5(F.to_json(F.struct(*keys)))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net changes from ``old`` to ``new``: an update is a DELETE of the old row and
    an INSERT of the new one, tied by ``row_id`` and ``is_update``."""
    columns = old.columns
    rest = [c for c in columns if c not in keys]
    a = old.select(*keys, F.struct(*rest).alias("_old"))
    b = new.select(*keys, F.struct(*[F.col(c) for c in rest]).alias("_new"))
    both = a.join(b, list(keys), "full")
    both = both.filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def half(action: str, row: str, is_update: bool) -> Column:
        return F.struct(F.lit(action).alias("action"), F.lit(is_update).alias("is_update"), F.col(row).alias("row"))

    halves = (
        F.when(F.col("_new").isNull(), F.array(half(DELETE, "_old", False)))
        .when(F.col("_old").isNull(), F.array(half(INSERT, "_new", False)))
        .otherwise(F.array(half(DELETE, "_old", True), half(INSERT, "_new", True)))
    )
    feed = both.select(*keys, F.explode(halves).alias("c"))
    return feed.select(
        *[F.col(c) if c in keys else F.col(f"c.row.{c}").alias(c) for c in columns],
        "c.action",
        "c.is_update",
        _row_id(keys).alias("row_id"),
    )


def appended(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only feed: new keys, updates and deletes ignored."""
    added = new.join(old.select(*keys), list(keys), "left_anti")
    return added.withColumns({"action": F.lit(INSERT), "row_id": _row_id(keys)})


def apply_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], sequence: Sequence[Order] | None = None
) -> DataFrame:
    """Fold a feed into a table; folding it twice changes nothing more.

    Old halves of updates carry no news and are dropped.  When a feed spans several
    rounds, ``sequence`` orders them and the last change of a key counts.
    """
    news = feed.filter((F.col("action") == INSERT) | ~F.col("is_update"))
    if sequence:
        news = newest(news, keys, sequence)
    news = news.select(*target.columns, "action")
    values = {c: F.col(f"s.{c}") for c in target.columns if c not in keys}
    gone, come = F.col("s.action") == DELETE, F.col("s.action") == INSERT
    return merge(
        target,
        news,
        keys,
        matched=[Clause("delete", gone), Clause("update", come, values)],
        not_matched=[Clause("insert", come, values)],
        unique=sequence is not None,
    )


def as_of_state(
    log: DataFrame,
    keys: Sequence[str],
    at: Column | None = None,
    before_change: int | None = None,
    stamp: str = "changed_at",
    change_id: str = "change_id",
) -> DataFrame:
    """The table as a change log left it at a time, or just before a change."""
    if at is not None:
        log = log.filter(F.col(stamp) <= at)
    if before_change is not None:
        log = log.filter(F.col(change_id) < before_change)
    last = newest(log, keys, [Order(stamp), Order(change_id)])
    return last.filter(F.col("action") != DELETE).drop("action", stamp, change_id)


def restore_values(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Put snapshot values back, row by key; rows the snapshot lacks stay."""
    old = snapshot.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_seen"))
    both = current.join(old, list(keys), "left")
    back = {c: F.when(F.col("_seen"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return both.withColumns(back).select(*current.columns)


def missing_rows(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot rows whose key is gone."""
    return snapshot.join(current.select(*keys), list(keys), "left_anti")


def recover_deleted(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return current.unionByName(missing_rows(current, snapshot, keys))


def merge_totals(stored: DataFrame, delta: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Fold newly inserted rows into a stored (rows, total, low, high) aggregate."""
    part = totals(delta, keys, value)
    return stored.unionByName(part).groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def totals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )
