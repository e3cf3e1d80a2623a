"""Normalised collections, the answer store, and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import annotate


def read_or_empty(spark: SparkSession, path: str, schema: str, kind: str = "json") -> DataFrame:
    """A collection with a fixed schema; a missing path is an empty collection.

    ``kind``: ``json`` is one document or list a file, each file one task; ``jsonl`` (a record a line) and ``parquet`` are
    split among tasks, and are what large collections should come in.
    """
    try:
        reader = spark.read.schema(schema)
        return reader.parquet(path) if kind == "parquet" else reader.option("multiLine", kind == "json").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_trials(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return read_or_empty(spark, path, schemas.TRIAL, kind)


def read_matches(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Trial matches from a flat list or from a patient's envelope, with ``ord``; ``kind`` is json or jsonl."""
    raw = spark.read.schema(f"{schemas.TRIAL_MATCH}, trial_match array<struct<{schemas.TRIAL_MATCH.replace(chr(10), ' ').strip()}>>").option("multiLine", kind == "json").json(path)
    flat = raw.filter("trial_match IS NULL").drop("trial_match")
    packed = raw.select(F.explode("trial_match").alias("m")).select("m.*")
    return flat.unionByName(packed).withColumn("ord", F.monotonically_increasing_id())


def read_vocabulary(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Distinct names of a landed vocabulary file; ``kind`` is json or jsonl."""
    return spark.read.schema("name string").option("multiLine", kind == "json").json(path).filter("name IS NOT NULL").distinct()


def read_gene_kb(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return read_vocabulary(spark, path, kind).select(F.upper("name").alias("name")).distinct()


class SuggestionStore:
    """Answers as Parquet files: appended, never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, annotate.STORE_SCHEMA, "parquet")

    def append(self, answers: DataFrame) -> None:
        answers.select("cache_key", "value_json", "is_null", "ord").write.mode("append").parquet(self.path)


def write_collection(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """``kind``: parquet, or json and jsonl, which Spark both writes as a record a line."""
    df.write.mode("overwrite").format("json" if kind == "jsonl" else kind).save(path)


def write_diff(routed: DataFrame, path: str) -> None:
    """One folder for each route."""
    routed.write.mode("overwrite").partitionBy("route").parquet(path)


def write_tiers(tiered: DataFrame, path: str) -> None:
    """One folder for each tier."""
    tiered.write.mode("overwrite").partitionBy("tier").parquet(path)


def write_sectioned_report(sections: dict[str, DataFrame], path: str) -> None:
    """One CSV folder for each section of a report, named by its number and title; a section may have several files."""
    for number, (title, df) in enumerate(sections.items(), 1):
        name = "".join(c if c.isalnum() else "_" for c in title.lower())
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{number}_{name}")
