"""Writing query results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators.groups import Order, dense_ids


def single_csv(df: DataFrame, path: str, order: Sequence[Order], rows: int, sep: str = ",") -> None:
    """The first ``rows`` rows as one file with a header.  One file is one task; for
    large exports use ``csv_parts``."""
    first = df.orderBy(*[o.column() for o in order]).limit(rows)
    first.coalesce(1).write.option("header", True).option("sep", sep).csv(path)


def csv_parts(df: DataFrame, path: str, rows_per_file: int = 5_000_000, compression: str = "gzip", sep: str = ",") -> None:
    """Compressed part files written in parallel, none above a number of rows."""
    w = df.write.option("header", True).option("sep", sep).option("compression", compression)
    w.option("maxRecordsPerFile", rows_per_file).csv(path)


def json_lines(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    df.write.option("ignoreNullFields", not keep_nulls).json(path)


def json_array_texts(df: DataFrame, order: Sequence[Order], rows_per_array: int = 1000) -> DataFrame:
    """Rows as JSON arrays of bounded length: (chunk, doc)."""
    columns = df.columns
    placed = dense_ids(df, order, "_pos", start=0)
    chunk = F.floor(F.col("_pos") / rows_per_array)
    g = placed.groupBy(chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("_pos", F.struct(*columns).alias("row")))).alias("l"))
    return g.select("chunk", F.to_json(F.transform("l", lambda x: x["row"])).alias("doc"))


def json_arrays(df: DataFrame, path: str, order: Sequence[Order], rows_per_array: int = 1000) -> None:
    """One JSON array per file."""
    texts = json_array_texts(df, order, rows_per_array).select("doc")
    texts.write.option("maxRecordsPerFile", 1).text(path)


def partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """A folder per value.  Rebalancing gathers small values into few files and
    spreads a large one over several."""
    df.hint("rebalance", *by).write.partitionBy(*by).format(fmt).save(path)


def create_table_as(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Persist a result (overwrite, append, errorifexists) and hand back the table."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
