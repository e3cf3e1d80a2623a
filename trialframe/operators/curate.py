"""Curated trials: suggestions united, confidence tiers, diagnoses recovered from titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from . import annotate, nodes, vocab

SPECIAL_NAMES = ("_SOLID_", "_LIQUID_")


def curate(suggestions: DataFrame, biomarkers: DataFrame, key: str) -> DataFrame:
    """(key, suggestions, biomarker_references, final_suggested_ctml).

    ``suggestions`` (key, nth, source, text, suggested_node): a trial's criteria in order and, last, its
    title's; ``biomarkers`` (key, nth, reference, biomarker, type, in_kb).
    """
    row = F.struct("source", "text", "suggested_node", F.lit(False).alias("transferred_to_match"))
    united = suggestions.groupBy(key).agg(clean.ordered_list("nth", row).alias("suggestions"))
    reference = F.struct("reference", "biomarker", "type", "in_kb")
    marked = biomarkers.groupBy(key).agg(clean.ordered_list("nth", reference).alias("biomarker_references"))
    out = united.join(marked, key, "left")
    empty = F.array().cast(marked.schema["biomarker_references"].dataType)
    final = nodes.union_nodes(F.transform("suggestions", lambda s: s["suggested_node"]))
    return out.select(key, "suggestions", F.coalesce("biomarker_references", empty).alias("biomarker_references"), final.alias("final_suggested_ctml"))


def allowed_only(types: Column, allowed: list[str]) -> Column:
    """Every type is allowed; true without any."""
    return F.forall(F.coalesce(types, F.array().cast("array<string>")), lambda t: F.coalesce(t.isin(*allowed), F.lit(False)))


def split_by_confidence(trials: DataFrame, has_diagnosis: Column, types: Column, allowed: list[str]) -> DataFrame:
    """``trials`` with ``tier``: high_confidence or needs_curation."""
    sure = F.coalesce(has_diagnosis, F.lit(False)) & allowed_only(types, allowed)
    return trials.withColumn("tier", F.when(sure, "high_confidence").otherwise("needs_curation"))


def recovery_worklist(trials: DataFrame, key: str, trial_id: str, title: str, summary: str) -> DataFrame:
    """(key, text, cache_key) of trials whose diagnosis is to be read from title and summary."""
    text = clean.strip(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))))
    rows = trials.withColumn("text", text).filter("text <> ''")
    return rows.select(key, "text", clean.cache_key(F.lit("diagnosis"), F.col(trial_id), F.col("text")).alias("cache_key"))


def recovered_diagnoses(worklist: DataFrame, store: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """(key, diagnoses): stored names resolved, special names kept, each once in order."""
    answers = annotate.look_up(worklist, store).filter("hit").select(key, F.from_json("value_json", "array<string>").alias("names"))
    each = answers.select(key, F.posexplode("names").alias("pos", "name"))
    special = F.col("name").isin(*SPECIAL_NAMES)
    fixed = vocab.resolve(each.filter(~special), vocabulary).unionByName(each.filter(special).withColumn("resolved", F.col("name")))
    return vocab.ordered_distinct(fixed, key, "pos", "resolved", "diagnoses")
