"""Incremental runs as file streams."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import annotate, lifecycle
from ..sources.collections import SuggestionStore


def annotate_stream(worklist: DataFrame, store: SuggestionStore, fn: Callable[[pd.Series], pd.Series], checkpoint: str) -> StreamingQuery:
    """Annotate a stream of items (cache_key, text): each batch's misses go through ``fn`` and into the store."""

    def batch(items: DataFrame, number: int) -> None:
        store.append(annotate.annotate(annotate.misses(items, store.read()), fn, ord=number))

    return worklist.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recompute_stream(changes: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """For each batch of changed rows, ``compute`` the result of the affected keys and append it with the batch's number."""

    def batch(rows: DataFrame, number: int) -> None:
        compute(rows.select(key).distinct()).withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(out)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The latest result of each key of a ``recompute_stream``."""
    return lifecycle.last_write_wins(spark.read.parquet(out), key, "batch").drop("batch")
