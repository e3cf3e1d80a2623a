"""Snapshots over time: what changed, what is carried forward, what went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_write_wins(df: DataFrame, key: str, ord: str) -> DataFrame:
    """The row of each key with the greatest ``ord``; thinned out before the shuffle, by a sort-based aggregation (its
    buffer is a whole row)."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), ord).alias("row"))
    # the key itself, so that Spark knows that the rows are dealt by it
    return best.select(*[F.col(c) if c == key else F.col("row")[c].alias(c) for c in df.columns])


def save_master(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as the table ``name`` in the warehouse, bucketed and sorted by ``key``, and read from there.

    A snapshot is compared with such a master without an exchange or a sort of the master: only the new rows are dealt to its buckets.
    Of a hundred terabytes that is all that moves in a week. ``buckets`` should give each about as much as a task holds. A table of that name is replaced; rows without a key share a bucket.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def split_keyless(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rejects)."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def snapshot_diff(new: DataFrame, master: DataFrame, key: str, compared: Column, ord: str | None = None) -> DataFrame:
    """(key, route): ``unchanged``, ``changed`` or ``deleted`` for all keys of both snapshots.

    ``compared`` is what decides on equality, as a short digest rather than a document. Each row of
    ``new`` gets a route; of the master's rows of one key the last by ``ord`` counts.
    """
    left = new.select(F.col(key).alias("new_key"), compared.alias("new_value"))
    master = last_write_wins(master, key, ord) if ord else master
    right = master.select(F.col(key).alias("old_key"), compared.alias("old_value"))
    same = F.col("new_value").eqNullSafe(F.col("old_value"))
    route = F.when(F.col("new_key").isNull(), "deleted").when(F.col("old_key").isNotNull() & same, "unchanged").otherwise("changed")
    joined = left.join(right, F.col("new_key") == F.col("old_key"), "full")
    return joined.select(F.coalesce("new_key", "old_key").alias(key), route.alias("route"))


def route_snapshot(new: DataFrame, master: DataFrame, key: str, compared: Column, carried: list[str], ord: str | None = None) -> DataFrame:
    """All rows with their ``route``: new rows, where unchanged with the master's ``carried`` columns,
    and the master's rows that are gone (as far as they have the new rows' columns)."""
    columns = new.columns
    latest = last_write_wins(master, key, ord) if ord else master
    left = new.withColumn("__value", compared).alias("n")
    right = latest.withColumn("__value", compared).alias("m")
    joined = left.join(right, F.col(f"n.{key}") == F.col(f"m.{key}"), "full")
    gone = F.col(f"n.{key}").isNull()
    same = F.col(f"m.{key}").isNotNull() & F.col("n.__value").eqNullSafe(F.col("m.__value"))
    route = F.when(gone, "deleted").when(same, "unchanged").otherwise("changed")
    picked = [F.when(gone | (same if c in carried else F.lit(False)), F.col(f"m.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in columns]
    return joined.select(*picked, route.alias("route"))


def merge_master(unchanged: DataFrame, curated: DataFrame) -> DataFrame:
    """Carried and freshly curated rows together; nothing is de-duplicated."""
    return unchanged.unionByName(curated)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once: a check on a merged master."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def route_counts(routed: DataFrame, route: str = "route") -> DataFrame:
    return routed.groupBy(route).agg(F.count("*").alias("n"))
