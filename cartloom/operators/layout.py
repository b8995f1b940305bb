"""How well files separate the values of a column, and layouts that do it better."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.groups import Neighbour, Order, Running, in_order

# Bytes of input that one file of a rewrite takes.
FILE_BYTES = 128 << 20


def folder() -> Column:
    """The folder of a row's file, for layouts judged by folder."""
    return F.regexp_extract("_metadata.file_path", "^(.*)/", 1)


def file_ranges(df: DataFrame, column: str, unit: Column | None = None) -> DataFrame:
    """Smallest and largest value per data file (or other unit), reading that column
    only."""
    unit = F.col("_metadata.file_path") if unit is None else unit
    return df.groupBy(unit.alias("file")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("rows")
    )


def _number(c: str, df: DataFrame, at: str) -> Column:
    """Column ``at``, of the kind of the column ``c`` of ``df``, as a number."""
    kind = dict(df.dtypes)[c]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(at).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(at).cast("double")
    return F.col(at).cast("double")


def clustering_report(df: DataFrame, columns: str | Sequence[str], unit: Column | None = None) -> DataFrame:
    """One row per column: files, mean overlaps (other files whose range meets a file's
    own) and mean depth (files covering a value, averaged over the covered range).

    One scan takes the ranges of all columns. A sweep over their ends, two rows per file
    and column, counts the files open at each: the ends are cut into pieces by column
    and value, and what is open at a cut is carried on from one summary row per piece, so
    no task sees all files. Files without a value of a column have no range there.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    unit = F.col("_metadata.file_path") if unit is None else unit
    number = lambda end, c: _number(c, df, end)
    ranges = df.groupBy(unit.alias("file")).agg(*[end(c).alias(f"{label}{k}") for k, c in enumerate(columns) for label, end in (("lo", F.min), ("hi", F.max))])
    end = lambda c, k, label, closing: F.struct(F.lit(c).alias("column"), number(f"{label}{k}", c).alias("at"), F.lit(closing).alias("closing"))
    ends = F.array(*[end(c, k, *x) for k, c in enumerate(columns) for x in (("lo", 0), ("hi", 1))])
    ends = ranges.select("file", F.inline(ends)).where(F.col("at").isNotNull()).withColumn("opening", 1 - F.col("closing"))
    sweep = [Order("column"), Order("at"), Order("closing"), Order("file")]
    e = in_order(ends, [], sweep, [Running("opened", "opening"), Running("closed", "closing"), Neighbour("next", "at", 1), Neighbour("of_next", "column", 1)])
    # running counts go on from column to column; all files of a column close in it
    cover = F.col("opened") - F.col("closed")
    width = F.when(F.col("of_next") == F.col("column"), F.col("next") - F.col("at")).otherwise(0.0)
    e = e.withColumns({"cover": cover, "width": width})

    # Files that end before this one starts, and files that started by its end.
    ended_before = F.max(F.when(F.col("closing") == 0, F.col("closed")))
    started_by = F.max(F.when(F.col("closing") == 1, F.col("opened")))
    covered = F.sum(F.when(F.col("cover") > 0, F.col("width")))
    per_file = e.groupBy("column", "file").agg(
        (started_by - ended_before - 1).alias("overlaps"), covered.alias("covered"), F.sum(F.col("cover") * F.col("width")).alias("area")
    )
    files, area = F.count(F.lit(1)), F.sum("covered")
    return per_file.groupBy("column").agg(
        files.alias("files"),
        F.round(F.avg("overlaps"), 4).alias("avg_overlaps"),
        # ranges that are all one and the same value lie on top of each other
        F.round(F.when(area > 0, F.sum("area") / area).otherwise(files.cast("double")), 4).alias("avg_depth"),
    )


def pruning_report(df: DataFrame, column: str, low, high, unit: Column | None = None) -> DataFrame:
    """Files a range predicate must read, by their value ranges."""
    r = file_ranges(df, column, unit)
    needed = (F.col("hi") >= F.lit(low)) & (F.col("lo") <= F.lit(high))
    return r.agg(F.count(F.lit(1)).alias("files"), F.count_if(needed).alias("files_scanned")).withColumn(
        "pct_scanned", F.round(100.0 * F.col("files_scanned") / F.col("files"), 2)
    )


def files_for(df: DataFrame, least: int = 1) -> int:
    """Files of about ``FILE_BYTES`` for the sizes that the planner knows of the tables read."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(least, -(-size // FILE_BYTES))


def cluster_rewrite(df: DataFrame, path: str, keys: Sequence[str], least: int = 1, bloom: str | None = None) -> DataFrame:
    """Rewrite sorted by ``keys`` into at least ``least`` files, more for more bytes.

    The range cut follows all keys, so a value that fills a large part of the table
    is cut by the later keys; end the list with a column that varies.  With ``bloom``
    the row groups also carry a Bloom filter for that column.
    """
    cut = df.repartitionByRange(files_for(df, least), *keys).sortWithinPartitions(*keys)
    if bloom is None:
        cut.write.parquet(path)
    else:
        write_with_bloom(cut, path, bloom, df.agg(F.approx_count_distinct(bloom)).first()[0])
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_with_bloom(df: DataFrame, path: str, column: str, distinct_values: int) -> None:
    """Files whose row groups carry a Bloom filter for ``column``."""
    w = df.write.option(f"parquet.bloom.filter.enabled#{column}", "true")
    w.option(f"parquet.bloom.filter.expected.ndv#{column}", str(max(1, distinct_values))).parquet(path)
