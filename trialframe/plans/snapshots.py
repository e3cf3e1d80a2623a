"""Snapshot queries: orders as trials, earlier and later selections of them as snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import lifecycle
from .registry import query, table

_SNAPSHOTS = """
WITH m AS (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus || '-curated' AS curated, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority || '*' ELSE o_orderpriority END AS p, o_orderstatus AS curated, o_totalprice FROM orders WHERE o_orderkey % 10 <> 1),
d AS (SELECT coalesce(n.o_orderkey, m.o_orderkey) AS o_orderkey, n.p, n.curated AS n_curated, m.curated AS m_curated, coalesce(n.o_totalprice, m.o_totalprice) AS o_totalprice,
  CASE WHEN n.o_orderkey IS NULL THEN 'deleted' WHEN m.o_orderkey IS NOT NULL AND n.p IS NOT DISTINCT FROM m.p THEN 'unchanged' ELSE 'changed' END AS route
  FROM n FULL JOIN m ON n.o_orderkey = m.o_orderkey)
"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(new, master): the master lacks some orders, the new one others, and some priorities differ."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("curated"), "o_totalprice")
    master = orders.filter("o_orderkey % 10 <> 0").withColumn("curated", F.concat("curated", F.lit("-curated")))
    altered = F.when(F.col("o_orderkey") % 7 == 0, F.concat("p", F.lit("*"))).otherwise(F.col("p"))
    return orders.filter("o_orderkey % 10 <> 1").withColumn("p", altered), master


@query(_SNAPSHOTS + "SELECT o_orderkey, route FROM d")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, master = snapshots(spark, sf_dir)
    return lifecycle.snapshot_diff(new, master, "o_orderkey", F.md5("p"))


@query(_SNAPSHOTS + "SELECT route, count(*) AS n FROM d GROUP BY route")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.route_counts(snapshot_diff(spark, sf_dir))


@query(_SNAPSHOTS + "SELECT o_orderkey, CASE WHEN route = 'unchanged' THEN m_curated ELSE n_curated || '-reviewed' END AS curated, o_totalprice FROM d WHERE route <> 'deleted'")
def carry_forward_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, master = snapshots(spark, sf_dir)
    routed = lifecycle.route_snapshot(new, master, "o_orderkey", F.md5("p"), carried=["curated"]).drop("p")
    unchanged = routed.filter("route = 'unchanged'").drop("route")
    curated = routed.filter("route = 'changed'").drop("route").withColumn("curated", F.concat("curated", F.lit("-reviewed")))
    return lifecycle.merge_master(unchanged, curated)


@query("""SELECT o_orderkey, sha256('{"a":{"m":[{"c":' || o_custkey || ',"p":"' || o_orderpriority || '"}],"status":"' || o_orderstatus || '"},"key":' || o_orderkey || '}') AS hash FROM orders""")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects whose keys come in another order than the hash takes them, with a fetch time that it leaves out."""
    inner = F.to_json(F.array(F.struct(F.col("o_orderpriority").alias("p"), F.col("o_custkey").alias("c"))))
    raw = F.concat(F.lit('{"key": '), "o_orderkey", F.lit(', "fetched_at": "'), F.col("o_orderdate").cast("string"), F.lit('", "a": {"status": "'), "o_orderstatus", F.lit('", "m": '), inner, F.lit("}}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", clean.content_hash(raw).alias("hash"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("ord"))
    return lifecycle.last_write_wins(events, "user_id", "ord").drop("ord")


@query(_SNAPSHOTS + "SELECT o_orderkey, route FROM d")
def bucketed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same diff against a master that is kept in buckets."""
    new, master = snapshots(spark, sf_dir)
    kept = lifecycle.save_master(master, f"orders_master_{uuid.uuid4().hex}", "o_orderkey", 8)
    return lifecycle.snapshot_diff(new, kept, "o_orderkey", F.md5("p"))
