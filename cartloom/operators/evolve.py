"""Schema change as new table versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types that may follow a type without losing a value.
WIDER = {
    "tinyint": ["smallint", "int", "bigint", "double"],
    "smallint": ["int", "bigint", "double"],
    "int": ["bigint", "double"],
    "float": ["double"],
    "date": ["timestamp_ntz"],
}


def add_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """``columns``: name -> (type, default); a None default means NULL."""
    taken = [c for c in columns if c in df.columns]
    if taken:
        raise ValueError(f"columns exist already: {taken}")
    return df.withColumns({c: F.lit(default).cast(kind) for c, (kind, default) in columns.items()})


def backfill(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), value))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(names)


def widen(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Change to a wider type; refuse a change that could lose values."""
    for column, new in types.items():
        old = df.schema[column].dataType
        if isinstance(old, T.DecimalType) and new.startswith("decimal"):
            target = T._parse_datatype_string(new)
            grows = target.scale >= old.scale and target.precision - target.scale >= old.precision - old.scale
        else:
            grows = new == old.simpleString() or new in WIDER.get(old.simpleString(), [])
        if not grows:
            raise ValueError(f"{column}: {old.simpleString()} cannot become {new} without loss")
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def retype(df: DataFrame, column: str, new: str, rejected: str = "rejected") -> DataFrame:
    """``column`` as ``new``; text that does not convert moves to ``rejected``.

    One scan serves both outputs: the failures are the rows where ``rejected``
    is not NULL.
    """
    raw = F.col(column)
    bad = raw.isNotNull() & raw.try_cast(new).isNull()
    return df.withColumn(rejected, F.when(bad, raw)).withColumn(column, raw.try_cast(new))
