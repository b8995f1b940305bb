"""Per-group work that stays spread out when one group is very large.

A window or a join by key sends every row of a key to one task.  The functions
here first count rows per key (map-side combined, reading only the key columns).
Keys up to ``HOT_ROWS`` take the ordinary plan.  Rows of larger keys are sorted
over many tasks by key *and* order, solved piece by piece, and stitched together
through one summary row per piece.  Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.session import durable

# Rows of one key that a single task may sort.
HOT_ROWS = 5_000_000


@dataclass(frozen=True)
class Order:
    """One sort column; NULLs last, as the data model states."""

    name: str
    descending: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()


@dataclass(frozen=True)
class Position:
    """1, 2, 3 … in order."""

    out: str


@dataclass(frozen=True)
class Running:
    """Sum of ``source`` from the first row to this one."""

    out: str
    source: str


@dataclass(frozen=True)
class Neighbour:
    """``source`` of the previous (step -1) or next (step +1) row."""

    out: str
    source: str
    step: int = -1


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return test


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most rows / hot_rows of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)


ASK = object()


def find_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """The hot keys, stored, or None; one pass over the key columns.  A caller with
    several windows over the same rows finds them once and hands them on."""
    hot = hot_groups(df, keys, hot_rows or HOT_ROWS)
    return None if hot.isEmpty() else durable(hot)


def _split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    if not keys:
        return None, df
    # Bounded by construction (see hot_groups), hence safe to broadcast.
    listed = F.broadcast(hot.select(*keys).alias("h"))
    rows = df.alias("r")
    cold = rows.join(listed, _same("r", "h", keys), "left_anti")
    return cold, rows.join(listed, _same("r", "h", keys), "left_semi")


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence[Order], outputs) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[o.column() for o in order])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    added = {}
    for o in outputs:
        if isinstance(o, Position):
            added[o.out] = F.row_number().over(w).cast("bigint")
        elif isinstance(o, Running):
            added[o.out] = F.sum(o.source).over(upto)
        elif o.step < 0:
            added[o.out] = F.lag(o.source, -o.step).over(w)
        else:
            added[o.out] = F.lead(o.source, o.step).over(w)
    return df.withColumns(added)


def _pieces(hot: DataFrame, limit: int) -> int:
    """Pieces for the rows of the hot keys: none much above ``limit`` rows."""
    return _pieces_of(hot.sparkSession, hot.agg(F.sum("_rows")).first()[0], limit)


def _pieces_of(spark: SparkSession, total: int, limit: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // limit))


def _in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[Order], outputs, pieces: int) -> DataFrame:
    by_order = [o.column() for o in order]
    # A range partition on key and order cuts a hot key into contiguous runs; it is
    # stored so that the cut points stay the same for the passes below.
    cut = df.repartitionByRange(pieces, *[F.col(k) for k in keys], *by_order)
    cut = durable(cut.withColumn("_piece", F.spark_partition_id()))

    part = [*keys, "_piece"]
    w = Window.partitionBy(*part).orderBy(*by_order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_at", F.row_number().over(w))

    added, summary, carry = {}, {"_size": F.count(F.lit(1))}, {}
    before = Window.partitionBy(*keys).orderBy("_piece")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    for i, o in enumerate(outputs):
        c = f"_c{i}"
        if isinstance(o, Position):
            carry[c] = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
            added[o.out] = (F.col("_at") + F.col(c)).cast("bigint")
        elif isinstance(o, Running):
            summary[f"_s{i}"] = F.sum(o.source)
            carry[c] = F.sum(f"_s{i}").over(earlier)
            here = F.sum(o.source).over(upto)
            # NULL only where no value has been seen at all, as for a plain sum.
            added[o.out] = F.coalesce(here + F.col(c), here, F.col(c))
        else:
            if abs(o.step) != 1:
                raise ValueError("only the direct neighbour can be carried over a cut")
            back = o.step < 0
            edge = F.max_by(o.source, "_at") if back else F.min_by(o.source, "_at")
            summary[f"_s{i}"] = edge
            carry[c] = F.lag(f"_s{i}").over(before) if back else F.lead(f"_s{i}").over(before)
            inside = F.lag(o.source).over(w) if back else F.lead(o.source).over(w)
            at_edge = F.col("_at") == (F.lit(1) if back else F.col("_size"))
            added[o.out] = F.when(at_edge, F.col(c)).otherwise(inside)

    ends = cut.groupBy(*part).agg(*[v.alias(k) for k, v in summary.items()])
    ends = ends.withColumns(carry).select(*part, "_size", *carry)
    # One row per piece and hot key: bounded by pieces + hot keys.
    joined = cut.alias("r").join(F.broadcast(ends.alias("e")), _same("r", "e", part), "inner")
    joined = joined.select("r.*", "e._size", *[f"e.{c}" for c in carry])
    return joined.withColumns(added).select(*df.columns, *added)


def in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order],
    outputs: Sequence[Position | Running | Neighbour],
    hot_rows: int | None = None,
    hot=ASK,
) -> DataFrame:
    """Add ordered-window columns per key.  ``order`` must end in a unique column.

    Without keys all rows are one group, which is always solved in pieces.
    """
    if not keys:
        return _in_pieces(df, keys, order, outputs, _pieces_of(df.sparkSession, df.count(), hot_rows or HOT_ROWS))
    if hot is ASK:
        hot = find_hot(df, keys, hot_rows)
    if hot is None:
        return _plain(df, keys, order, outputs)
    cold, heavy = _split_hot(df, keys, hot)
    done = _in_pieces(heavy, keys, order, outputs, _pieces(hot, hot_rows or HOT_ROWS))
    return done if cold is None else _plain(cold, keys, order, outputs).unionByName(done)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    by: Order,
    rank: str = "rank",
    dense: str = "dense_rank",
    hot_rows: int | None = None,
    hot=ASK,
) -> DataFrame:
    """Rank with gaps and without, ties sharing a rank.  Without keys distinct values
    are counted and placed in pieces, whatever their number."""
    if keys and hot is ASK:
        hot = find_hot(df, keys, hot_rows)
    w = Window.partitionBy(*keys).orderBy(by.column())

    def direct(d: DataFrame) -> DataFrame:
        return d.withColumns(
            {rank: F.rank().over(w).cast("bigint"), dense: F.dense_rank().over(w).cast("bigint")}
        )

    if keys and hot is None:
        return direct(df)
    cold, heavy = _split_hot(df, keys, hot)
    # Rank of a value = rows before its first row; counted on distinct values, so
    # that any number of ties is one row here.
    values = heavy.groupBy(*keys, by.name).agg(F.count(F.lit(1)).alias("_n"))
    values = in_order(values, keys, [by], [Position(dense), Running("_upto", "_n")], hot_rows)
    values = durable(values.withColumn(rank, F.col("_upto") - F.col("_n") + 1))
    on = [*keys, by.name]
    placed = attach(heavy, values, on, "_n", df.columns, hot_rows).select(*df.columns, rank, dense)
    return placed if cold is None else direct(cold).unionByName(placed)


def tiles(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order],
    n: int,
    out: str,
    hot_rows: int | None = None,
    hot=ASK,
) -> DataFrame:
    """Cut each group into ``n`` nearly equal tiles, larger tiles first."""
    if keys and hot is ASK:
        hot = find_hot(df, keys, hot_rows)
    if keys and hot is None:
        w = Window.partitionBy(*keys).orderBy(*[o.column() for o in order])
        return df.withColumn(out, F.ntile(n).over(w).cast("bigint"))
    placed = in_order(df, keys, order, [Position("_pos")], hot_rows, hot)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    if keys:
        placed = attach(placed, sizes, keys, "_all", [o.name for o in order], hot_rows)
    else:
        placed = placed.withColumn("_all", sizes.scalar())
    small, extra = F.floor(F.col("_all") / n), F.col("_all") % n
    in_large = extra * (small + 1)
    tile = F.when(F.col("_pos") <= in_large, F.ceil(F.col("_pos") / (small + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("_pos") - in_large, small))
    )
    return placed.withColumn(out, tile.cast("bigint")).drop("_pos", "_all")


def attach(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size: str,
    spread_by: Sequence[str],
    hot_rows: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join per-key ``stats`` back to the rows they came from.

    ``size`` is the row count column of ``stats``.  A key above ``hot_rows`` is
    served by several tasks: its stats row is repeated once per task (in total at
    most rows / hot_rows copies) and its rows pick a copy by a hash of
    ``spread_by``, which is stable when a task is run again.  NULL keys meet NULL keys.
    """
    limit = hot_rows or HOT_ROWS
    copies = F.ceil(F.col(size) / limit).cast("int")
    hot = stats.filter(F.col(size) > limit).select(*keys, copies.alias("_copies"))
    marked = rows.alias("r").join(F.broadcast(hot.alias("h")), _same("r", "h", keys), "left").select("r.*", "h._copies")
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_copies")), F.lit(0)).cast("int")
    marked = marked.withColumn("_salt", salt).drop("_copies")
    served = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    values = [c for c in stats.columns if c not in keys]
    joined = marked.alias("r").join(served.alias("s"), _same("r", "s", [*keys, "_salt"]), how)
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"s.{c}") for c in values])


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """The last row of each key under ``order``.

    ``row_number() = 1`` becomes a per-task group limit before the shuffle, so at
    most one row per key and task travels, hot keys included.
    """
    back = [Order(o.name, not o.descending).column() for o in order]
    w = Window.partitionBy(*keys).orderBy(*back)
    return df.withColumn("_last", F.row_number().over(w)).filter(F.col("_last") == 1).drop("_last")


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Order], k: int, out: str) -> DataFrame:
    """The first ``k`` rows of each key with their place; same group-limit plan."""
    w = Window.partitionBy(*keys).orderBy(*[o.column() for o in order])
    return df.withColumn(out, F.row_number().over(w).cast("bigint")).filter(F.col(out) <= k)


def first_rows(
    df: DataFrame,
    order: Sequence[Order],
    k: int,
    day: Column,
    newest_first: bool,
    hot_rows: int | None = None,
) -> DataFrame:
    """``orderBy(order).limit(k)`` for a large ``k``.

    A plain limit sorts everything and makes every task hand up to ``k`` rows to one
    task.  Here rows are counted per ``day`` (the leading sort column, cut to a coarse
    value) to find the day in which row ``k`` lies.  Only days up to it are joined and
    sorted; the predicate reaches the scan that holds the day.  If that one day is
    itself very large, its rows are placed by ``in_order``.  Rows without a day come
    last in either direction, as NULLs do in the order.
    """
    limit = hot_rows or HOT_ROWS
    by = [o.column() for o in order]
    w = Window.orderBy(F.col("_day").desc_nulls_last() if newest_first else F.col("_day").asc_nulls_last())
    counts = df.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per calendar day.
    upto = counts.withColumn("_upto", F.sum("_n").over(w)).filter(F.col("_upto") >= k)
    edge = upto.orderBy("_upto").first()
    if edge is None:
        return df.orderBy(*by)
    if edge["_day"] is None:
        before, here = day.isNotNull(), day.isNull()
    else:
        last = F.lit(edge["_day"])
        before, here = (day > last if newest_first else day < last), day == last
    if edge["_n"] <= limit:
        return df.filter(before | here).orderBy(*by).limit(k)
    within = df.filter(before)
    at_edge = in_order(df.filter(here), [], order, [Position("_pos")], limit)
    rest = at_edge.filter(F.col("_pos") <= k - (edge["_upto"] - edge["_n"])).drop("_pos")
    return within.unionByName(rest).orderBy(*by)


def dense_ids(df: DataFrame, order: Sequence[Order], out: str, start: int = 1) -> DataFrame:
    """Gap-free ids from ``start`` in the given order, without a one-task window
    once the table is larger than one task should sort."""
    numbered = in_order(df, [], order, [Position(out)])
    return numbered.withColumn(out, F.col(out) + (start - 1))
