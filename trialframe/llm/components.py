"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable from each node that has a link.

    ``links`` has two long columns a, b. A large-star step links each node's greater neighbours
    to its least one, a small-star step does so for its lesser neighbours; the links become
    stars around the least nodes after about log(n) rounds. Each step is an aggregation and a
    join on the node, which adaptive execution can split where a node has very many links.
    Every round is written to the shared folder and the one before it deleted.
    """
    spark = links.sparkSession
    edges = common.written(_ordered(links.select("a", "b")), "links")
    seen = _state(edges)
    while seen[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = _ordered(large)
        # now a > b in all rows: a node's lesser neighbours
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = common.written(_ordered(small.union(least.select("a", F.col("m").alias("b")))), "links")
        now = _state(after)
        common.drop_path(spark, _folder(edges))
        edges = after
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).head()
    return row[0], row[1] or 0


def _folder(df: DataFrame) -> str:
    return df.inputFiles()[0].rpartition("/")[0]
