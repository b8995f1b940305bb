"""User-defined functions.

Rules that built-in functions can express are plain column functions; Arrow
batches are used only where the point is to run the user's own Python code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.scalar import r2

# Shipping labels by order status.
STATUS_LABELS = {
    "placed": "Order Received",
    "processing": "Being Prepared",
    "shipped": "On Its Way",
    "delivered": "Delivered",
    "cancelled": "Cancelled",
}
UNKNOWN_STATUS = "Unknown Status"


def margin_pct(price: Column, cost: Column) -> Column:
    """Gross margin in percent; NULL without a price or without a margin."""
    zero = F.lit(0.0)
    return r2(F.nullif(price - cost, zero) / F.nullif(price, zero) * 100)


def order_tier(total: Column, steps: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Name of the first step (highest first) that ``total`` reaches."""
    tier = F.lit(lowest)
    for limit, name in reversed(steps):
        tier = F.when(total >= limit, name).otherwise(tier)
    return tier


def customer_score(orders: Column, spent: Column, days: Column) -> Column:
    return r2(orders * 10 + spent * 0.01 + days * 0.5)


def status_label(status: Column) -> Column:
    label = F.lit(UNKNOWN_STATUS)
    for code, text in STATUS_LABELS.items():
        label = F.when(status == code, text).otherwise(label)
    return label


def clean_phone(raw: Column) -> Column:
    """Digits only; ten digits become ``(xxx) xxx-xxxx``; no digit at all, NULL."""
    digits = F.nullif(F.regexp_replace(raw, "[^0-9]", ""), F.lit(""))
    spaced = F.regexp_replace(digits, "^(.{3})(.{3})(.{4})$", "($1) $2-$3")
    return F.when(F.length(digits) == 10, spaced).otherwise(digits)


def email_domain(email: Column) -> Column:
    """Lower-case domain; NULL unless there is exactly one ``@``."""
    parts = F.split(email, "@")
    return F.when((F.length(email) > 0) & (F.size(parts) == 2), F.lower(F.element_at(parts, -1)))


def format_currency(amount: Column) -> Column:
    text = F.format_number(F.abs(amount).cast("decimal(38,4)"), 2)
    return F.concat(F.when(amount < 0, "$-").otherwise("$"), text)


def discount_tiers(discount: pd.Series) -> pd.Series:
    """Batch form of the discount tier, for use as an Arrow UDF."""
    tier = pd.Series("no_discount", index=discount.index)
    tier[discount > 0] = "light_discount"
    tier[discount >= 0.15] = "moderate_discount"
    tier[discount >= 0.3] = "heavy_discount"
    return tier


def vectorized(fn: Callable[[pd.Series], pd.Series], returns: T.DataType) -> Callable[..., Column]:
    """A Python function over column batches, moved through Arrow."""
    return F.pandas_udf(fn, returnType=returns)


def custom_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    state: str,
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge: dict[str, Column],
) -> DataFrame:
    """A user-defined aggregate with a partial step.

    ``partial`` reduces one Arrow batch to state rows (``keys`` + ``state`` DDL)
    where the rows lie; only states are shuffled, and ``merge`` combines them with
    built-in aggregates.  A key with very many rows therefore never meets in one
    Python process.
    """

    def reduce_batches(batches):
        for pdf in batches:
            if len(pdf):
                yield partial(pdf)

    key_ddl = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    states = df.mapInPandas(reduce_batches, f"{key_ddl}, {state}")
    return states.groupBy(*keys).agg(*[c.alias(name) for name, c in merge.items()])


def register_sql_functions(spark) -> None:
    """The margin rule as a SQL function, for callers who write SQL."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION gross_margin_pct(price DOUBLE, cost DOUBLE) RETURNS DOUBLE "
        "RETURN cast(round(cast(nullif(price - cost, 0) / nullif(price, 0) * 100 AS decimal(38,6)), 2) AS double)"
    )
