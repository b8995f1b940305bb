"""Alerts over streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cartloom.operators.metering import tumbling

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stamped(stream: DataFrame, at: str, lateness: str) -> DataFrame:
    """Event time as an instant, with rows later than ``lateness`` let go."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)


def slices(stream: DataFrame, at: str, width: str, by: Sequence[str] = (), *aggs: Column) -> DataFrame:
    """Closed time slices of a watermarked stream, one row per slice that has rows."""
    return tumbling(stream, at, width, list(by), *(aggs or (F.count(F.lit(1)).alias("rejected"),)))


class Spells(StatefulProcessor):
    """Opens an alert with the first slice of a spell, closes it when the spell is over."""

    def __init__(self, seconds: int):
        self.gap = pd.Timedelta(seconds=seconds)

    def init(self, handle) -> None:
        self.handle = handle
        self.spell = handle.getValueState("spell", "started timestamp, seen timestamp, rejected bigint")

    def _forget(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("first")
        events = []
        spell = self.spell.get() if self.spell.exists() else None
        started, seen, count = (pd.Timestamp(spell[0]), pd.Timestamp(spell[1]), spell[2]) if spell else (None, None, 0)
        for first, last, n in zip(new["first"], new["last"], new["rejected"]):
            if started is not None and first - seen > self.gap:
                events.append(("cleared", seen + self.gap, count))
                started = None
            if started is None:
                started, count = first, 0
                events.append(("fired", first, None))
            seen, count = last, count + int(n)
        self.spell.update((started.to_pydatetime(), seen.to_pydatetime(), count))
        self._forget()
        # A row that goes on with the spell lies in a slice that is closed by then.
        self.handle.registerTimer(int((seen + 2 * self.gap).timestamp() * 1000))
        yield self._rows(key, events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        spell = self.spell.get()
        self.spell.clear()
        yield self._rows(key, [("cleared", pd.Timestamp(spell[1]) + self.gap, spell[2])])

    def _rows(self, key, events) -> pd.DataFrame:
        rows = [(*key, *e) for e in events]
        names = [*[f"k{i}" for i in range(len(key))], "state", "at", "rejected"]
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"at": "datetime64[us]", "rejected": "Int64"})

    def close(self) -> None:
        pass


def spells(stream: DataFrame, at: str, gap_seconds: int, by: Sequence[str]) -> DataFrame:
    """``by..., state, at, rejected``: alerts of a watermarked stream of rejected rows.

    An alert fires at the first rejected row of a key and is cleared ``gap_seconds`` after
    its last one; rows no further apart than that belong to one spell, which fires once.
    ``cleared`` carries the number of rows. Rows are first reduced to slices as wide as the
    gap, whose rows are always of one spell, so a key with very many rows reaches its state
    as one row a slice; slices arrive closed, so late and repeated files change nothing
    beyond the rows they bring in time. A NULL key is a key; a NULL time is no row.
    """
    width = f"{gap_seconds} seconds"
    rows = stream.where(F.col(at).isNotNull()).groupBy(F.window(at, width), *by).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("rejected")
    )
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    out = ", ".join([*[f"k{i} {kinds[c]}" for i, c in enumerate(by)], "state string, at timestamp, rejected bigint"])
    events = rows.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=Spells(gap_seconds), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    return events.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(by)], "state", "at", "rejected")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in the store that processors need."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)
