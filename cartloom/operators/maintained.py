"""Totals per key that outlive a call and are refreshed from new files alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators.changes import merge_totals, totals
from cartloom.session import durable
from cartloom.sources.ledger import IDENTITY, Ledger


@dataclass(frozen=True)
class Staleness:
    """How far stored totals lie behind their source: files and bytes not folded in yet,
    and whether a folded file was changed or removed, which only a rebuild can mend."""

    refreshed: int
    pending_files: int
    pending_bytes: int
    rebuild: bool

    @property
    def stale(self) -> bool:
        return self.rebuild or self.pending_files > 0


@dataclass(frozen=True)
class MaintainedTotals:
    """Count, sum, least and largest ``value`` per key over a growing folder of Parquet files.

    The mark up to which the source is folded in is the set of its files, kept in a
    ``Ledger`` beside the totals: exact for files that are added in any order, unlike the
    largest time or id seen. A refresh reads files beyond the mark and the stored totals,
    writes a new version, and moves the mark. If it fails before, the next one starts
    from the same mark and replaces what was begun. ``prepare`` shapes the stored rows
    before they are summed, row by row.
    """

    spark: SparkSession
    path: str
    source: str
    keys: tuple[str, ...]
    value: str
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/files")

    def _version(self, load: int) -> str:
        return f"{self.path}/totals/load={load}"

    def _state(self) -> tuple[Staleness, DataFrame]:
        mark = self.ledger.entries().select(*IDENTITY, F.lit(True).alias("folded"))
        both = self.ledger.files(self.source).join(mark, IDENTITY, "full")
        new, gone = F.col("folded").isNull(), F.col("path").isNull()
        counts = both.agg(F.count_if(new).alias("n"), F.coalesce(F.sum(F.when(new, F.col("length"))), F.lit(0)).alias("size"), F.count_if(gone).alias("gone")).first()
        state = Staleness(max(self.ledger.loads(), default=-1), counts["n"], counts["size"], counts["gone"] > 0)
        return state, both.where(new).select("path", *IDENTITY)

    def staleness(self) -> Staleness:
        """Compare file listings; no row is read."""
        return self._state()[0]

    def refresh(self) -> Staleness:
        """Bring the totals up to date; how far behind they were."""
        state, files = self._state()
        if state.rebuild:
            self._forget()
            return Staleness(state.refreshed, self.refresh().pending_files, state.pending_bytes, True)
        if not state.pending_files:
            return state
        load, files = self.ledger.next_load(), durable(files)
        rows = self.prepare(self.spark.read.parquet(*[f["path"] for f in files.select("path").collect()]))
        if load == 0:
            after = totals(rows, self.keys, self.value)
        else:
            after = merge_totals(self.read(), rows, self.keys, self.value)
        after.write.mode("overwrite").parquet(self._version(load))
        self.ledger.record(files.withColumn("status", F.lit("LOADED")), load)
        if load > 1:  # the version before stays for readers that have begun
            self._delete(self._version(load - 2))
        return state

    def read(self) -> DataFrame:
        """The totals as of the last refresh."""
        done = self.ledger.loads()
        if not done:
            raise LookupError(f"nothing below {self.source} has been folded in yet")
        return self.spark.read.parquet(self._version(done[-1]))

    def _forget(self) -> None:
        # the mark goes first, so that totals without a mark are never read
        self._delete(self.ledger.path)
        self._delete(f"{self.path}/totals")

    def _delete(self, path: str) -> None:
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
