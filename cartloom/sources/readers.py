"""Reading files into typed DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.sources import arrays

# Texts that mean NULL in a delimited file.
NULL_TOKENS = ["NULL", "null", "NA", "N/A", "n/a", ""]


@dataclass(frozen=True)
class CsvFormat:
    """A named file format for delimited text; gzip is recognised by suffix."""

    sep: str = ","
    encoding: str = "UTF-8"
    line_sep: str | None = None
    quote: str = '"'
    nulls: Sequence[str] = tuple(NULL_TOKENS)
    date_format: str | None = None
    timestamp_format: str | None = None
    true_text: Sequence[str] = ()
    false_text: Sequence[str] = ()

    def options(self) -> dict[str, str]:
        o = {"sep": self.sep, "encoding": self.encoding, "quote": self.quote, "escape": self.quote}
        if self.line_sep:
            o["lineSep"] = self.line_sep
        return o


def as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def cleaned(raw: Column, fmt: CsvFormat) -> Column:
    text = F.trim(raw)
    return F.when(~text.isin(list(fmt.nulls)), text)


def converted(text: Column, kind: T.DataType, fmt: CsvFormat, strict: bool) -> Column:
    """``text`` as ``kind``: an error for bad text when strict, else NULL."""
    if isinstance(kind, T.DateType) and fmt.date_format:
        return (F.to_date if strict else F.try_to_date)(text, fmt.date_format)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)) and fmt.timestamp_format:
        form = fmt.timestamp_format
        return (F.to_timestamp(text, form) if strict else F.try_to_timestamp(text, F.lit(form))).cast(kind)
    if isinstance(kind, T.BooleanType) and (fmt.true_text or fmt.false_text):
        known = F.when(text.isin(list(fmt.true_text)), True).when(text.isin(list(fmt.false_text)), False)
        return known.otherwise(text.cast(kind) if strict else text.try_cast(kind))
    return text.cast(kind) if strict else text.try_cast(kind)


def csv_text(spark: SparkSession, path: str | list[str], fmt: CsvFormat = CsvFormat(), pattern: str | None = None) -> DataFrame:
    """A headed CSV, all columns as text and named by the header; a file whose
    header differs is refused and not read by position."""
    reader = spark.read.options(**fmt.options()).option("header", True).option("enforceSchema", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def csv_typed(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, fmt: CsvFormat = CsvFormat(), pattern: str | None = None
) -> DataFrame:
    """Typed load: NULL texts, trimming and formats applied, bad text is an error."""
    raw = csv_text(spark, path, fmt, pattern)
    return raw.select(
        *[converted(cleaned(F.col(f.name), fmt), f.dataType, fmt, strict=True).alias(f.name) for f in as_struct(schema)]
    )


def csv_positional(spark: SparkSession, path: str, columns: Mapping[int, tuple[str, str]], fmt: CsvFormat = CsvFormat(), skip_header: bool = True) -> DataFrame:
    """Columns picked by place (from 1) straight from the files: place -> (name, type)."""
    raw = spark.read.options(**fmt.options()).option("header", skip_header).option("enforceSchema", True).csv(path)
    return raw.select(
        *[
            converted(cleaned(F.col(f"`{raw.columns[i - 1]}`"), fmt), as_struct(f"x {kind}")[0].dataType, fmt, True).alias(name)
            for i, (name, kind) in columns.items()
        ]
    )


def json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array: one VARIANT per element, a large file read by
    many tasks. Compressed files, and those of a file system that only Spark's readers
    open, are one task each, and refused above the size of a VARIANT (128 MB)."""
    cut = arrays.ranged(spark, path)
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("mode", "FAILFAST")
    if cut:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(arrays.COMPRESSED) + "}")
    elements = F.explode_outer(F.variant_get("doc", "$", "array<variant>"))
    whole = reader.option("singleVariantColumn", "doc").json(path).select(elements.alias("doc")).filter(F.col("doc").isNotNull())
    return arrays.element_texts(spark, path).select(F.parse_json("value").alias("doc")).unionByName(whole) if cut else whole


def json_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One JSON document per line, splittable: one VARIANT per row."""
    parse = F.parse_json if strict else F.try_parse_json
    return spark.read.text(path).select(parse("value").alias("doc"))


def parquet_by_name(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Columns by name whatever their case or order; columns not asked for are not
    read, columns the files lack are NULL."""
    return spark.read.schema(as_struct(schema)).parquet(path)


def epoch_timestamp(value: Column, scale: int) -> Column:
    """An epoch count of seconds (0), milliseconds (3) or microseconds (6)."""
    make = {0: F.timestamp_seconds, 3: F.timestamp_millis, 6: F.timestamp_micros}[scale]
    return make(value).cast("timestamp_ntz")


def orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def xml(spark: SparkSession, path: str, row_tag: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(as_struct(schema)).load(path)


def avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the spark-avro package on the class path."""
    return spark.read.format("avro").load(path)
