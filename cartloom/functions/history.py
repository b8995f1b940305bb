"""A table function over monthly rows of any table."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Groups of keys that share a partition, so that a batch holds many keys, and rows per batch returned.
GROUPS = 1024
BATCH_ROWS = 65536


def changes(values: pa.Array) -> np.ndarray:
    """For each value but the first, whether it differs from the one before; NULLs are equal."""
    if pa.types.is_nested(values.type):
        return np.array([a != b for a, b in itertools.pairwise(values.to_pylist())], dtype=bool)
    after, before = values[1:], values[:-1]
    differs = pc.fill_null(pc.not_equal(after, before), False)
    return pc.or_(differs, pc.xor(after.is_null(), before.is_null())).to_numpy(zero_copy_only=False)


class MonthlyHistory:
    """Months between the first and the last row of a key, filled, with streaks.

    It returns the table's columns and ``streak``. A month without a row has zeros in the
    numeric columns and NULL in others; ``streak`` counts the months in a row, up to this
    one, in which ``active`` is above 0. A key must hold a month at most once. Rows without
    a month are returned as they are, with a NULL streak.

    ``eval`` works on whole Arrow batches of a partition that holds many keys, in order of
    key and month; the last row seen carries a key over to the next batch.
    """

    def __init__(self):
        self.key = None
        self.number, self.dated, self.streak = 0, False, 0

    def eval(self, table, key, month, active):
        if not table.num_rows:
            return
        key, month, active = (a[0].as_py() for a in (key, month, active))
        at = table.column(month)
        local = pc.local_timestamp(at) if getattr(at.type, "tz", None) else at
        times = local.to_numpy(zero_copy_only=False)
        dated, number = ~np.isnat(times), times.astype("datetime64[M]").astype("int64")
        gap, streak = self.follow(table.column(key), number, dated, self.is_active(table.column(active)) & dated)
        ends = np.cumsum(gap + 1) - 1  # place of each row among the rows returned
        for start in range(0, int(ends[-1]) + 1, BATCH_ROWS):
            place = np.arange(start, min(start + BATCH_ROWS, int(ends[-1]) + 1))
            row = np.searchsorted(ends, place)  # the row itself or, for an empty month, the next one
            back = ends[row] - place
            columns = []
            for name, column in zip(table.schema.names, table.columns, strict=True):
                if name == month:
                    columns.append(self.months(at, times, number, row, back))
                elif name == key:
                    columns.append(column.take(pa.array(row)))
                else:
                    columns.append(self.emptied(column, row, back > 0))
            columns.append(pa.array(np.where(back > 0, 0, streak[row]), mask=~dated[row]))
            yield pa.RecordBatch.from_arrays(columns, names=[*table.schema.names, "streak"])

    def follow(self, keys: pa.Array, number: np.ndarray, dated: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Empty months before each row and its streak, going on from the rows seen before."""
        if self.key is None:
            new = np.concatenate([[True], changes(keys)])
        else:
            new = changes(pa.concat_arrays([self.key, keys]))
        before = np.concatenate([[self.number], number[:-1]])
        follows = ~new & dated & np.concatenate([[self.dated], dated[:-1]])
        gap = np.where(follows, np.maximum(number - before - 1, 0), 0)
        index = np.arange(len(number))
        # The last row before the streak; a streak begun in an earlier batch ends that many rows before this one.
        cut = np.where(follows & (gap == 0), -1 - self.streak, index - 1)
        streak = index - np.maximum.accumulate(np.where(active, cut, index))
        self.key = keys.take(pa.array([len(keys) - 1]))
        self.number, self.dated, self.streak = int(number[-1]), bool(dated[-1]), int(streak[-1])
        return gap, streak

    @staticmethod
    def is_active(column: pa.Array) -> np.ndarray:
        column = column.cast(pa.int8()) if pa.types.is_boolean(column.type) else column
        return pc.fill_null(pc.greater(column, 0), False).to_numpy(zero_copy_only=False)

    @staticmethod
    def months(at: pa.Array, times: np.ndarray, number: np.ndarray, row: np.ndarray, back: np.ndarray) -> pa.Array:
        """The rows' own times; in empty months, the next row's moved back by whole months."""
        wanted = (number[row] - back).astype("datetime64[M]")
        moved = wanted.astype(times.dtype) + (times - times.astype("datetime64[M]").astype(times.dtype))[row]
        if (moved.astype("datetime64[M]") != wanted)[back > 0].any():
            raise ValueError("day is out of range for month")
        zone = getattr(at.type, "tz", None)
        moved = pa.array(moved, pa.timestamp(at.type.unit) if zone else at.type)
        moved = pc.assume_timezone(moved, zone, ambiguous="earliest", nonexistent="earliest") if zone else moved
        return pc.if_else(pa.array(back > 0), moved, at.take(pa.array(row)))

    @staticmethod
    def emptied(column: pa.Array, row: np.ndarray, empty: np.ndarray) -> pa.Array:
        if not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
            return column.take(pa.array(row, mask=empty))
        values = column.take(pa.array(row))
        return pc.if_else(pc.and_(pa.array(empty), values.is_valid()), pa.scalar(0, column.type), values)


def monthly_history(df: DataFrame, key: str, month: str, active: str) -> DataFrame:
    """``MonthlyHistory`` of ``df``; no view or function name is registered, so callers do not meet.

    Names and types are taken from the table given (an Arrow table function has no ``analyze``).
    """
    missing = [name for name in (key, month, active) if name not in df.columns]
    if missing or "streak" in df.columns:
        raise ValueError(f"the table lacks {missing}, or has a column streak")
    call = F.arrow_udtf(MonthlyHistory, returnType=T.StructType([*df.schema.fields, T.StructField("streak", T.LongType())]))
    group = F.pmod(F.hash(f"`{key}`"), F.lit(GROUPS))
    table = df.asTable().partitionBy(group).orderBy(F.col(f"`{key}`"), F.col(f"`{month}`"))
    return call(table, F.lit(key), F.lit(month), F.lit(active))
