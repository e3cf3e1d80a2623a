"""Annotation of texts by a caller's function, with a reusable store of answers.

Store: (cache_key, value_json, is_null, ord). A stored null is an answer, also for texts that the
function could make nothing of.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STORE_SCHEMA = "cache_key string, value_json string, is_null boolean, ord long"


def latest(store: DataFrame) -> DataFrame:
    """One answer for each key, the last written."""
    return store.groupBy("cache_key").agg(F.max_by(F.struct("value_json", "is_null"), "ord").alias("v")).select("cache_key", "v.*")


def look_up(worklist: DataFrame, store: DataFrame) -> DataFrame:
    """``worklist`` (with ``cache_key``) with ``value_json`` and ``hit``."""
    known = latest(store).withColumn("hit", F.lit(True))
    return worklist.join(known.drop("is_null"), "cache_key", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def misses(worklist: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct items without an answer."""
    return worklist.join(store.select("cache_key"), "cache_key", "left_anti").dropDuplicates(["cache_key"])


def progress(looked_up: DataFrame, key: str) -> DataFrame:
    """(key, n_items, n_cached)."""
    return looked_up.groupBy(key).agg(F.count("*").alias("n_items"), F.count_if("hit").alias("n_cached"))


def annotate(items: DataFrame, fn: Callable[[pd.Series], pd.Series], text: str = "text", ord: int = 0, partitions: int | None = None) -> DataFrame:
    """Store rows for distinct missed items: ``fn`` gets batches of texts and gives JSON texts or nulls.

    ``partitions`` spreads a slow function over more tasks.
    """
    rows = items.select("cache_key", F.col(text).alias("text"))
    rows = rows.repartition(partitions) if partitions else rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = fn(batch["text"])
            yield pd.DataFrame({"cache_key": batch["cache_key"], "value_json": values.array, "is_null": values.isna().array, "ord": ord})

    return rows.mapInPandas(run, STORE_SCHEMA)


def flag_known(df: DataFrame, name: str, known: DataFrame, known_name: str = "name", into: str = "in_kb") -> DataFrame:
    """``df`` with whether the upper case of ``name`` is in the table of known names."""
    table = known.select(F.upper(known_name).alias("__known")).distinct().withColumn(into, F.lit(True))
    out = df.join(table, F.upper(name) == F.col("__known"), "left")
    return out.withColumn(into, F.coalesce(into, F.lit(False))).drop("__known")
