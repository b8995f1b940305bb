"""Bulk loading of delimited files: validation, error policies, history."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.groups import attach
from cartloom.sources.readers import CsvFormat, as_struct, cleaned, converted, csv_text

CORRUPT = "_corrupt"


class OnError(Enum):
    ABORT = "abort"
    CONTINUE = "continue"
    SKIP_FILE = "skip_file"


class LoadError(RuntimeError):
    pass


def decoded(path: Column | str) -> Column:
    """A file's path as its folder lists it; ``_metadata`` gives it percent-encoded."""
    c = F.col(path) if isinstance(path, str) else path
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def local(path: Column | str) -> Column:
    """The path without the scheme of the local file system, to compare paths."""
    return F.regexp_replace(path, "^file:/+", "/")


def with_line_numbers(raw: DataFrame) -> DataFrame:
    """Number the records of each file, the header being line 1.

    A file is read in blocks.  A record's place inside its block comes from the
    row id of the scan; the records of the blocks before it are added from a table
    of one row per block.
    """
    numbered = raw.withColumns(
        {
            "_file": decoded("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_id": F.monotonically_increasing_id(),
        }
    )
    blocks = numbered.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    placed = numbered.join(blocks, ["_file", "_block"])
    line = F.col("_id") - F.col("_first") + F.col("_before") + 2
    return placed.withColumn("_line", line).drop("_id", "_first", "_before", "_block")


def checked(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, fmt: CsvFormat = CsvFormat(), pattern: str | None = None
) -> DataFrame:
    """Every record with typed columns, its file and line, and its errors.

    Columns are found by header name; all files must share one header.  No record
    is rejected here: a cell that does not convert is NULL and listed in ``_errors``
    as (column, type, value, message).
    """
    fields = as_struct(schema)
    header = csv_text(spark, path, fmt, pattern).columns
    missing = [f.name for f in fields if f.name not in header]
    if missing:
        raise LoadError(f"the files have no columns {missing}")
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    reader = spark.read.options(**fmt.options()).option("header", True).option("enforceSchema", False)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = with_line_numbers(reader.schema(texts).csv(path))

    typed, errors = {}, []
    for f in fields:
        text, kind = cleaned(F.col(f.name), fmt), f.dataType.simpleString()
        value = converted(text, f.dataType, fmt, strict=False)
        bad = text.isNotNull() & value.isNull()
        error = F.struct(
            F.lit(f.name).alias("column"),
            F.lit(kind).alias("type"),
            text.alias("value"),
            F.concat(F.lit("'"), text, F.lit(f"' is not a valid {kind}")).alias("message"),
        )
        errors.append(F.when(bad & F.col(CORRUPT).isNull(), error))
        typed[f.name] = value
    shape = F.struct(
        F.lit("").alias("column"),
        F.lit("").alias("type"),
        F.col(CORRUPT).alias("value"),
        F.lit(f"record does not have {len(header)} columns").alias("message"),
    )
    errors.append(F.when(F.col(CORRUPT).isNotNull(), shape))
    return raw.select(
        *[v.alias(c) for c, v in typed.items()], "_file", "_line", F.array_compact(F.array(*errors)).alias("_errors")
    )


def bad_cells(rows: DataFrame) -> DataFrame:
    """Dry run: one row per bad cell; empty for clean files."""
    return rows.select("_file", "_line", F.explode("_errors").alias("e")).select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), "e.column", "e.type", "e.value", "e.message"
    )


def load(rows: DataFrame, policy: OnError) -> DataFrame:
    """The rows that the policy lets in."""
    data = [c for c in rows.columns if not c.startswith("_")]
    clean = F.size("_errors") == 0
    if policy is OnError.ABORT:
        first = bad_cells(rows).orderBy("file", "line").limit(1).collect()
        if first:
            e = first[0]
            raise LoadError(f"{e['file']} line {e['line']} column {e['column']}: {e['message']}")
        return rows.select(*data)
    if policy is OnError.CONTINUE:
        return rows.filter(clean).select(*data)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), F.count_if(~clean).alias("_bad"))
    whole = files.filter(F.col("_bad") == 0)
    return attach(rows, whole, ["_file"], "_n", ["_line"]).select(*data)


def history(rows: DataFrame, policy: OnError) -> DataFrame:
    """What a load did, per file.  An aborted load took in nothing, clean files included."""
    faulty = F.size("_errors") > 0
    first = F.min(F.when(faulty, F.struct("_line", F.element_at("_errors", 1).alias("e"))))
    h = rows.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count_if(faulty).alias("error_count"), first.alias("_first")
    )
    errors, parsed = F.col("error_count"), F.col("rows_parsed")
    kept = {
        OnError.ABORT: F.lit(0).cast("bigint"),
        OnError.CONTINUE: parsed - errors,
        OnError.SKIP_FILE: F.lit(0).cast("bigint"),
    }[policy]
    failed = {OnError.ABORT: "LOAD_FAILED", OnError.CONTINUE: "PARTIALLY_LOADED", OnError.SKIP_FILE: "LOAD_SKIPPED"}[policy]
    status = F.when(errors == 0, "LOADED").otherwise(failed)
    if policy is OnError.CONTINUE:
        status = F.when((errors > 0) & (errors == parsed), "LOAD_FAILED").otherwise(status)
    loaded = F.when(errors == 0, parsed).otherwise(kept)
    if policy is OnError.ABORT:
        failing = rows.filter(faulty).limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
        status = F.when(failing > 0, "LOAD_FAILED").otherwise("LOADED")
        loaded = F.when(failing > 0, F.lit(0).cast("bigint")).otherwise(parsed)
    return h.select(
        "file",
        "rows_parsed",
        loaded.alias("rows_loaded"),
        "error_count",
        F.col("_first.e.message").alias("first_error"),
        F.col("_first._line").alias("first_error_line"),
        F.col("_first.e.column").alias("first_error_column"),
        status.alias("status"),
    )


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The files below a path; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")


def new_files(
    spark: SparkSession, path: str, loaded: DataFrame, pattern: str | None = None, force: bool = False
) -> list[str]:
    """Files not in the load history (``file``, ``status``); all of them with force.

    A file counts as loaded when its last rows went in; skipped or failed files are
    offered again.
    """
    found = listing(spark, path, pattern)
    if not force:
        done = loaded.filter(F.col("status").isin("LOADED", "PARTIALLY_LOADED"))
        done = done.select(local("file").alias("_path")).distinct()
        found = found.withColumn("_path", local("path")).join(done, "_path", "left_anti")
    return sorted(r["path"] for r in found.select("path").collect())
