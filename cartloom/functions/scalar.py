"""Column helpers shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r2(x: Column) -> Column:
    """Two decimals, half up, decided on decimal digits and not on binary ones."""
    return F.round(x.cast("decimal(38,6)"), 2).cast("double")


def _exact(total: Column) -> Column:
    """A sum of amounts with at most four decimals, freed from summation noise."""
    return F.round(total, 4)


def money(x: Column | str) -> Column:
    return F.round(_exact(F.sum(x)).cast("decimal(38,4)"), 2).cast("double")


def mean(x: Column | str) -> Column:
    return r2(_exact(F.sum(x)) / F.count(x))


def pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when there is no whole."""
    return r2(100.0 * part / F.nullif(whole, F.lit(0)))


def month(x: Column | str) -> Column:
    return F.date_trunc("month", x).cast("timestamp_ntz")


def rows() -> Column:
    return F.count(F.lit(1))


def refunded() -> Column:
    """Sum of refunds: nine tenths of the returned lines' amounts."""
    return r2(0.9 * _exact(F.sum("line_total")))


def total_of(x: str) -> Column:
    """Sum of partial sums of amounts, to two decimals."""
    return settled(F.sum(x))


def settled(total: Column) -> Column:
    """A summed amount, to two decimals."""
    return F.round(_exact(total).cast("decimal(38,4)"), 2).cast("double")
