"""Tiles of a whole table without sorting it: the rows at the borders are found by counting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.groups import Order

#: Counted ranges of one pass, and rows of a range that are listed instead of counted again.
RANGES, LISTED = 1024, 32768
#: Numbers are kept within this, so that their differences are finite; NaN counts as the largest.
LARGEST = 8e307


@dataclass(frozen=True)
class _Search:
    """Where one wanted row lies: the values of the leading columns, and the bounds of the next one.

    ``skip`` counts the rows before the range, ``held`` those in it.
    """

    place: int
    fixed: tuple[Any, ...] = ()
    low: float | None = None
    high: float | None = None
    skip: int = 0
    held: int = 0


def _as_number(name: str, kind: T.DataType) -> Column:
    """A number that never falls where the column rises; close values may share one."""
    c = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        c = c.cast("timestamp")
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)))


def _equal(name: str, value: Any) -> Column:
    return F.col(name).eqNullSafe(F.lit(value))


def _before(order: Sequence[Order], key: Sequence[Any]) -> Column:
    """Whether a row stands before ``key`` in the order; NULLs are last."""
    out = F.lit(False)
    for o, value in reversed(list(zip(order, key))):
        c = F.col(o.name)
        if value is None:
            out = c.isNotNull() | out
        else:
            first = c > F.lit(value) if o.descending else c < F.lit(value)
            out = F.coalesce(first, F.lit(False)) | (_equal(o.name, value) & out)
    return out


def _after(order: Sequence[Order], key: Sequence[Any]) -> Column:
    same = F.lit(True)
    for o, value in zip(order, key):
        same = same & _equal(o.name, value)
    return ~_before(order, key) & ~same


def rows_at(df: DataFrame, order: Sequence[Order], places: Sequence[int]) -> dict[int, tuple]:
    """The sort keys of the rows at ``places`` (from 1) in the order, whose columns end in a unique one.

    Columns are numbers, dates or timestamps. Each pass counts the rows of up to RANGES even
    ranges of the current column for every place searched, and goes on in the range that
    holds it; equal values lead to the next column. A range of at most LISTED rows is
    listed. So passes read narrow columns, shuffle counts only, and bring at most LISTED
    rows or RANGES counts a place to the driver, whatever the table's size. ``df`` is read once a
    pass and should be stored.
    """
    kinds = {o.name: df.schema[o.name].dataType for o in order}
    open_, found = [_Search(p) for p in places], {}
    by = [o.column() for o in order]
    while open_:
        seen: dict = {}
        open_ = [_bounded(df, order, kinds, s, seen) if s.low is None and len(s.fixed) < len(order) else s for s in open_]
        listed: dict[tuple, list[_Search]] = {}
        for s in open_:
            if s.held <= LISTED or len(s.fixed) == len(order):
                listed.setdefault((s.fixed, s.low, s.high, s.skip), []).append(s)
        for some in listed.values():
            rows = df.where(_within(order, kinds, some[0])).select(*[o.name for o in order])
            rows = rows.orderBy(*by).limit(max(s.place - s.skip for s in some)).collect()
            found |= {s.place: tuple(rows[s.place - s.skip - 1]) for s in some}
        open_ = _narrowed(df, order, kinds, [s for s in open_ if s.place not in found])
    return found


def _within(order: Sequence[Order], kinds: dict, s: _Search) -> Column:
    out = F.lit(True)
    for o, value in zip(order, s.fixed):
        out = out & _equal(o.name, value)
    if s.low is not None:
        number = _as_number(order[len(s.fixed)].name, kinds[order[len(s.fixed)].name])
        out = out & (number >= s.low) & (number <= s.high)
    return out


def _bounded(df: DataFrame, order: Sequence[Order], kinds: dict, s: _Search, seen: dict) -> _Search:
    """The range of the next column, or NULL fixed for it where the place lies among its NULLs."""
    name = order[len(s.fixed)].name
    number = _as_number(name, kinds[name])
    if s.fixed not in seen:
        ends = F.count(name).alias("n"), F.count(F.lit(1)).alias("all"), F.min(number).alias("low"), F.max(number).alias("high")
        seen[s.fixed] = df.where(_within(order, kinds, s)).agg(*ends).first()
    r = seen[s.fixed]
    if s.place - s.skip > r["n"]:
        if s.place - s.skip > r["all"]:
            raise IndexError(f"there is no row at {s.place}")
        return _Search(s.place, (*s.fixed, None), skip=s.skip + r["n"], held=r["all"] - r["n"])
    return _Search(s.place, s.fixed, r["low"], r["high"], s.skip, r["n"])


def _narrowed(df: DataFrame, order: Sequence[Order], kinds: dict, searches: list[_Search]) -> list[_Search]:
    """One counting pass for all searches."""
    if not searches:
        return []
    cells = []
    for k, s in enumerate(searches):
        if s.low is None:  # NULL has just been fixed
            continue
        name = order[len(s.fixed)].name
        number = _as_number(name, kinds[name])
        width = (s.high - s.low) / RANGES
        part = F.least(F.floor((number - s.low) / F.lit(width)), F.lit(RANGES - 1)).cast("int") if width > 0 else F.lit(0)
        cells.append(F.when(_within(order, kinds, s), F.struct(F.lit(k).alias("k"), part.alias("part"), number.alias("at"))))
    out = [s for s in searches if s.low is None]
    if not cells:
        return out
    each = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
    counts: dict[int, list] = {}
    for r in each.groupBy("c.k", "c.part").agg(F.count(F.lit(1)).alias("n"), F.min("c.at").alias("low"), F.max("c.at").alias("high")).collect():
        counts.setdefault(r["k"], []).append(r)
    for k, parts in counts.items():
        s, skip = searches[k], searches[k].skip
        at = order[len(s.fixed)]
        for r in sorted(parts, key=lambda r: r["part"], reverse=at.descending):
            if s.place - skip <= r["n"]:
                break
            skip += r["n"]
        inner = _Search(s.place, s.fixed, r["low"], r["high"], skip, r["n"])
        out.append(inner if (r["high"] - r["low"]) / RANGES > 0 else _settled(df, order, kinds, inner))
    return out


def _settled(df: DataFrame, order: Sequence[Order], kinds: dict, s: _Search) -> _Search:
    """One number is left: fix the column's value, of several that share it the one that holds the place."""
    name = order[len(s.fixed)].name
    values = df.where(_within(order, kinds, s)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    skip = s.skip
    for r in values.orderBy(order[len(s.fixed)].column()).collect():
        if s.place - skip <= r["n"]:
            break
        skip += r["n"]
    return _Search(s.place, (*s.fixed, r[name]), skip=skip, held=r["n"])


def tiles_of_all(df: DataFrame, order: Sequence[Order], n: int, out: str) -> DataFrame:
    """``df`` with its rows cut into ``n`` nearly equal tiles, larger ones first, as ``ntile`` does.

    The last rows of the tiles are found by ``rows_at``; then a row's tile is one more
    than the number of those before it, a plain expression without sort or shuffle.
    """
    size = df.count()
    small, extra = divmod(size, n)
    ends = {t * small + min(t, extra) for t in range(1, n)} - {0, size}
    found = rows_at(df, order, sorted(ends))
    tile = F.lit(1).cast("bigint")
    for key in found.values():
        tile = tile + _after(order, key).cast("bigint")
    return df.withColumn(out, tile)
