"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on; all may be changed on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches to Python are bounded by bytes as well as rows, since one row may be a long text.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def build_session(name: str = "cartloom", cpus: int | str = "*") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CARTLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a cluster
    such a folder would vanish with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _own_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/cartloom/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return f"{_own_root(spark)}/{label}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, label: str, *of: str) -> str:
    """The path of something that later calls find again, named by what it was made of."""
    mark = hashlib.sha256("\0".join(of).encode()).hexdigest()[:32]
    return f"{_own_root(spark)}/{label}-{mark}"


def release(spark: SparkSession) -> None:
    """Delete what this application stored; call it when its results are consumed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage and freezes the content, so that later passes see the same
    rows even when an executor is lost and its tasks run again.
    """
    spark = df.sparkSession
    path = scratch(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
