"""Corpus preparation: every stage is (spark, docs, sf_dir) -> DataFrame on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import benchmarks, language, lines, mixing, simhash
from cartloom.session import durable, tune


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; texts without letters and hopeless guesses go."""
    found = language.identify(docs, language.learn(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.MIN_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them repeat; n_chars follows the text."""
    out = lines.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return benchmarks.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each with the number of epochs it is seen."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash_dedup),
    ("decontaminate", decontaminate),
    ("source_mix", source_mix),
]

#: A learned model, Bloom filters and 64-bit shingle hashes have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next one reads it."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
