"""Continuous loading of files and queries kept current.

Every function works off what has arrived and stops (``availableNow``); a caller
repeats it on a schedule.  Progress is kept in a checkpoint, so a file is taken
once, and a run that failed is repeated without duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.sources.loading import decoded, listing, local


def arriving(
    spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet", pattern: str | None = None, **options
) -> DataFrame:
    """Files arriving below ``path`` as a stream."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def run(writer) -> None:
    """Take in everything that has arrived, then stop."""
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()


def append_to(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append each new row once; the file sink commits whole batches."""
    run(stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append"))


def with_source_file(stream: DataFrame) -> DataFrame:
    return stream.withColumn("source_file", decoded("_metadata.file_path"))


def lag(spark: SparkSession, source: str, ingested: DataFrame, pattern: str | None = None) -> DataFrame:
    """Files and bytes that have arrived, by whether they are loaded; rows loaded."""
    loaded = ingested.groupBy(local("source_file").alias("f")).agg(F.count(F.lit(1)).alias("rows"))
    files = listing(spark, source, pattern).select(local("path").alias("f"), "length")
    state = F.when(F.col("rows").isNull(), "pending").otherwise("loaded")
    return files.join(loaded, "f", "left").groupBy(state.alias("state")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def snapshots(stream: DataFrame, target: str, checkpoint: str, mode: str = "complete") -> None:
    """Keep a streaming aggregate as numbered snapshots, the highest being current.
    A repeated batch overwrites its own snapshot."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/version={number}")

    run(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode))


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the completely written versions below ``target``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{target}/version=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def current(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/version={versions(spark, target)[-1]}")


def each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    run(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint))
