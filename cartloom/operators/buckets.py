"""A keyed table stored in key buckets, of which a merge rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.changes import apply_changes
from cartloom.operators.groups import Order

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketTable:
    """Rows of unique ``keys`` in ``buckets`` folders by a hash of the keys.

    Version ``n`` of the table is a short list (``versions/n``) that names for every bucket
    the version whose merge wrote it last; the rows lie in ``parts/version=w/_bucket=b``.
    A merge writes the parts of the buckets that it touches, then the list. Until the list
    is complete, readers see the version before; a merge that is repeated after a failure
    reads that version again and replaces what it had begun.

    ``buckets`` should give each bucket a size one task can join, as its rows are
    rewritten together; the driver only ever handles bucket numbers.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """Version 0."""
        self._write(rows, 0)
        self._list(self._filled(0), 0)

    def versions(self) -> list[int]:
        return sorted(int(p.split("/")[-2].split("=")[1]) for p in self._glob("versions/version=*/_SUCCESS"))

    def parts(self, version: int | None = None) -> dict[int, int]:
        """The version that wrote each bucket last; buckets without rows are left out."""
        number = self.versions()[-1] if version is None else version
        listed = self.spark.read.schema("bucket int, version int").parquet(f"{self.path}/versions/version={number}")
        return {r.bucket: r.version for r in listed.collect()}

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the last one by default), of some buckets or all."""
        wanted = self.parts(version)
        if only is not None:
            wanted = {b: v for b, v in wanted.items() if b in set(only)}
        paths = [self._part(v, b) for b, v in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def fold(self, feed: DataFrame, version: int, sequence: Sequence[Order]) -> list[int]:
        """Turn ``version`` into the next one by a change feed; the buckets that were rewritten.

        Only the buckets that hold a key of the feed are read and written. Folding a feed
        again, in the same place or later, changes no row.
        """
        touched = sorted(r[0] for r in feed.select(self.bucket()).distinct().collect())
        parts = self.parts(version)
        if touched:
            after = apply_changes(self.read(version, touched), feed, list(self.keys), sequence)
            self._write(after, version + 1)
            # a bucket all of whose rows are gone has no folder and drops out
            parts = {b: v for b, v in parts.items() if b not in touched} | self._filled(version + 1)
        self._list(parts, version + 1)
        return touched

    def prune(self, keep: int = 2) -> None:
        """Delete parts and lists that the last ``keep`` versions do not need.

        A merge may have to be repeated from the version before its own, so two are the
        least that is safe while a stream runs.
        """
        known = self.versions()
        stay = known[-keep:]
        needed = {(v, b) for n in stay for b, v in self.parts(n).items()}
        for found in self._glob("parts/version=*/_bucket=*"):
            v, b = (int(x.split("=")[1]) for x in found.split("/")[-2:])
            if (v, b) not in needed and v <= known[-1]:
                self._delete(found)
        for n in known[:-keep]:
            self._delete(f"{self.path}/versions/version={n}")

    # -- storage ---------------------------------------------------------------------

    def _part(self, version: int, bucket: int) -> str:
        return f"{self.path}/parts/version={version}/{BUCKET}={bucket}"

    def _write(self, rows: DataFrame, version: int) -> None:
        dealt = rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()).repartition(BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/parts/version={version}")

    def _filled(self, version: int) -> dict[int, int]:
        return {int(p.split("=")[-1]): version for p in self._glob(f"parts/version={version}/{BUCKET}=*")}

    def _list(self, parts: dict[int, int], version: int) -> None:
        listed = self.spark.createDataFrame(sorted(parts.items()), "bucket int, version int").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")

    def _hadoop(self, path: str):
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(context._jsc.hadoopConfiguration())

    def _glob(self, pattern: str) -> list[str]:
        at, files = self._hadoop(f"{self.path}/{pattern}")
        return [f.getPath().toString() for f in files.globStatus(at) or []]

    def _delete(self, path: str) -> None:
        at, files = self._hadoop(path)
        files.delete(at, True)
