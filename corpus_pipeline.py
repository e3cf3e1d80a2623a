"""Corpus cleaning: documents in, token digests out.

Stages, each on all that the one before it kept:

1. ``language``: documents without a recognised language go (no letters, or no language is likely).
2. ``near_dedup``: of each group of copies and near-copies the document with the least id stays.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``secrets``: secrets inside texts become a mark; no document goes.
5. ``sentencepiece``: what is left is encoded and decoded.

The second stage is op8's ball hashing on five-word shingles together with MinHash bands, since fingerprints alone lose near-copies; every link is verified.

Null text counts as empty, so the first stage drops it. Rows with a null id pass the second stage as they are. Rows repeated in every column stay or go
together; texts of one id are told apart by their words, but a benchmark item in one drops all rows of its id. Of equally near documents the least id stays. Columns of any
name pass all stages but the last, which gives token digests. A text is one cell in every stage, however long. An empty table passes as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.llm import common, decontaminate, language, near_copies, pieces, queries, secret_scan

#: the least mean probability of the best language at which a document stays
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    other = {n: f"__{n}" for n in ("lang_pred", "score") if n in docs.columns}  # columns of any name come through unchanged
    found = language.identify(docs.withColumnsRenamed(other), language.train(docs))
    found = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).drop("lang_pred", "score")
    return found.withColumnsRenamed({v: k for k, v in other.items()}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(docs, queries.vocabulary("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("secrets", secrets),
    ("sentencepiece", tokens),
]

#: the language network and the tokenizer are beyond SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's output is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
