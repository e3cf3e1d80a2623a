"""Match selection: lineitems as matches, orders as samples, suppliers as protocols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import curate, matches, patients
from .registry import query, table

# every column breaks ties, since order and line number aren't a key
_TIES = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_PRIMARY = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END, l_linenumber, l_quantity, {_TIES}) AS rn FROM lineitem),
p AS (SELECT * FROM r WHERE rn = 1)
"""


def _priority() -> list[Column]:
    level, reason = (F.when(F.col(c) == v, 0).otherwise(1) for c, v in (("l_returnflag", "R"), ("l_linestatus", "F")))
    return [level, reason, F.array(F.col("l_linenumber").cast("double"), "l_quantity")]


def primary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    return lines, matches.primary_match(lines, "l_orderkey", _priority(), _TIES.split(", "))


@query(_PRIMARY + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus FROM p")
def primary_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary(spark, sf_dir)[1].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")


@query(
    _PRIMARY
    + f""", f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY {_TIES}) AS k FROM lineitem),
o AS (SELECT f.* FROM f JOIN p ON f.l_orderkey = p.l_orderkey WHERE f.k = 1 AND f.l_suppkey <> p.l_suppkey)
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_TIES})::INTEGER AS number FROM o"""
)
def other_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = matches.other_matches(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", _priority(), _TIES.split(", "))
    return rest.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "number")


@query(
    _PRIMARY
    + """, j AS (SELECT p.l_orderkey, pt.p_name, pt.p_brand, o.o_orderpriority, c.c_name, upper(substr(c.c_mktsegment, 1, 1)) || lower(substr(c.c_mktsegment, 2)) AS segment,
  CASE WHEN p.l_returnflag = 'R' THEN p.l_returnflag ELSE '' END AS flag
  FROM p LEFT JOIN part pt ON p.l_partkey = pt.p_partkey LEFT JOIN orders o ON p.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
u AS (SELECT l_orderkey, 'Name' AS label, p_name AS value FROM j UNION ALL SELECT l_orderkey, 'Brand', p_brand FROM j UNION ALL SELECT l_orderkey, 'Priority', o_orderpriority FROM j
  UNION ALL SELECT l_orderkey, 'Customer', c_name FROM j UNION ALL SELECT l_orderkey, 'Segment', segment FROM j UNION ALL SELECT l_orderkey, 'Flag', flag FROM j)
SELECT * FROM u WHERE value IS NOT NULL AND value <> ''"""
)
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary lines with their part, order and customer as labelled rows."""
    best = primary(spark, sf_dir)[1]
    joined = best.join(table(spark, sf_dir, "part"), best.l_partkey == F.col("p_partkey"), "left")
    joined = joined.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    joined = joined.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    flag = F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).otherwise("")
    fields = {"Name": F.col("p_name"), "Brand": F.col("p_brand"), "Priority": F.col("o_orderpriority"), "Customer": F.col("c_name"), "Segment": clean.capitalized(F.col("c_mktsegment")), "Flag": flag}
    return joined.select("l_orderkey", F.explode(clean.labelled_rows(fields)).alias("r")).select("l_orderkey", "r.label", "r.value")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')")
def trim_referenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    orders = table(spark, sf_dir, "orders").join(some, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return matches.trim_referenced(table(spark, sf_dir, "part").select("p_partkey", "p_name"), lines.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey")


@query("SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') AND bool_and(l_linestatus IN ('F')) THEN 'high_confidence' ELSE 'needs_curation' END AS tier FROM lineitem GROUP BY l_orderkey")
def tier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    trials = lines.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("has"), F.collect_set("l_linestatus").alias("types"))
    return curate.split_by_confidence(trials, F.col("has"), F.col("types"), ["F"]).select("l_orderkey", "tier")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return patients.valid_only(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), people, "o_custkey")
