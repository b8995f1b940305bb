"""What has been loaded: a table of file identities, appended with each load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.session import durable
from cartloom.sources import loading
from cartloom.sources.loading import OnError, listing, local
from cartloom.sources.readers import CsvFormat

IDENTITY = ["file", "length", "modified"]
SCHEMA = "file string, length bigint, modified timestamp, status string"
DONE = ("LOADED", "PARTIALLY_LOADED")


@dataclass(frozen=True)
class Ledger:
    """Files that went in, each as path, length and modification time, by load number.

    The entries of load ``n`` are one folder, written after the data of the load, so they
    are what makes the load count: a load that fails before is repeated under the same
    number and replaces what it had written.
    """

    spark: SparkSession
    path: str

    def loads(self) -> list[int]:
        """Numbers of the finished loads."""
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/load=*/_SUCCESS")
        found = at.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(at)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def next_load(self) -> int:
        return max(self.loads(), default=-1) + 1

    def entries(self) -> DataFrame:
        """All entries with their ``load``; none before the first load."""
        done = self.loads()
        if not done:
            return self.spark.createDataFrame([], f"{SCHEMA}, load int")
        reader = self.spark.read.schema(f"{SCHEMA}, load int").option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/load={n}" for n in done])

    def files(self, folder: str, pattern: str | None = None) -> DataFrame:
        """The files below a folder now, as ``path`` and identity; nothing is read of them."""
        return listing(self.spark, folder, pattern).select(
            "path", local("path").alias("file"), "length", F.col("modificationTime").alias("modified")
        )

    def pending(self, folder: str, pattern: str | None = None, force: bool = False) -> DataFrame:
        """Files to load: those that no load took in as they are now, or all with ``force``.

        A file replaced under its name has another length or time and is offered again,
        as is one that was skipped or failed.
        """
        found = self.files(folder, pattern)
        if force:
            return found
        done = self.entries().where(F.col("status").isin(*DONE)).select(*IDENTITY).distinct()
        return found.join(done, IDENTITY, "left_anti").select("path", *IDENTITY)

    def record(self, files: DataFrame, load: int) -> None:
        """Finish load ``load``: ``files`` has the identity and status of each file it read."""
        files.select("file", "length", "modified", "status").write.mode("overwrite").parquet(f"{self.path}/load={load}")


def load_folder(
    ledger: Ledger,
    folder: str,
    table: str,
    schema: str,
    policy: OnError = OnError.CONTINUE,
    fmt: CsvFormat = CsvFormat(),
    pattern: str | None = None,
    force: bool = False,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Load what is pending below ``folder`` into ``table``; the number of files taken up.

    Rows go to a folder of the load, then the ledger gets its entries. An aborted load
    writes neither. File identities are taken before the files are read, so one replaced
    in between is loaded again rather than missed.
    """
    known = durable(ledger.pending(folder, pattern, force))
    paths = [f["path"] for f in known.select("path").collect()]  # a reader holds its paths in the driver anyway
    if not paths:
        return 0
    load = ledger.next_load()
    rows = loading.checked(ledger.spark, paths, schema, fmt)
    finish(loading.load(rows, policy)).write.mode("overwrite").parquet(f"{table}/load={load}")
    done = loading.history(rows, policy).select(local("file").alias("_file"), F.col("status").alias("_status"))
    # a file without records has no history and nothing wrong with it
    status = F.coalesce("_status", F.lit("LOADED")).alias("status")
    ledger.record(known.join(done, F.col("file") == F.col("_file"), "left").select(*IDENTITY, status), load)
    return len(paths)


def loaded_rows(ledger: Ledger, table: str) -> DataFrame:
    """The rows of all finished loads, with their ``load`` number."""
    paths = [f"{table}/load={n}" for n in ledger.loads()]
    return ledger.spark.read.option("basePath", table).parquet(*paths)
