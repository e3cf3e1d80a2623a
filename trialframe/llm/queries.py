"""The operators of this package applied to the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, common, decontaminate, language, license_scan, oracle, pieces, prefix_trie, recompress, secret_scan, simhash, spelling, token_counts, token_files, topk_search


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language.train(docs)
    rows = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.identify(rows, net).drop("text")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    segments = common.written(chat_format.format_turns(turns.union(probe)), "chat")
    return chat_format.digest(segments).drop("n_attachments", "attachment_tokens")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_decode(docs, vocabulary("piece_bpe_32k.model"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "token-files")
    token_files.write_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return token_files.read_files(spark, path)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_token_counts": op2_token_counts,
    "op3_language": op3_language,
    "op4_chat_format": op4_chat_format,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_simhash": op8_simhash,
    "op9_token_files": op9_token_files,
    "op10_decontamination": op10_decontamination,
    "op11_license_scan": op11_license_scan,
    "op12_spelling": op12_spelling,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
