"""A file stream over the driver's tables, run to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir
from ..streaming import incremental
from .registry import query, table


@query("SELECT user_id, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY user_id")
def stream_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of changes: each batch recomputes the users that it names from the whole table."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    changes = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque*")  # a pattern, since the table may be a file or a folder

    def compute(keys: DataFrame) -> DataFrame:
        return events.join(keys, "user_id", "left_semi").groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))

    incremental.recompute_stream(changes, "user_id", compute, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return incremental.current(spark, f"{folder}/out", "user_id")
