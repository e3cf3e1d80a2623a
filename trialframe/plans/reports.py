"""Report context: lineitems as matches, orders as samples and patients, suppliers as protocols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matches
from .registry import query, table

# every column breaks ties, since order and line number aren't a key
_TIES = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_CASES = {
    "status": "CASE l_linestatus WHEN 'O' THEN 'OPEN to accrual' END",
    "level": "CASE l_returnflag WHEN 'R' THEN 'arm' ELSE 'step' END",
    "reason": "CASE l_linestatus WHEN 'F' THEN 'genomic' ELSE 'clinical' END",
    "kind": "CASE WHEN l_linenumber % 2 = 0 THEN 'variant' ELSE '' END",
    "shown": "CASE l_linenumber % 5 WHEN 4 THEN false WHEN 3 THEN NULL ELSE true END",
}

_MATCHES = f"""
WITH m AS (SELECT *, l_orderkey::VARCHAR AS sample_id, 'S' || l_suppkey AS protocol_no, 'N' || l_partkey AS nct_id, {_CASES['status']} AS status, {_CASES['level']} AS level,
  {_CASES['reason']} AS reason, {_CASES['kind']} AS kind, CASE WHEN l_linenumber % 3 = 0 THEN [99, 99] ELSE [l_linenumber::BIGINT, l_quantity::BIGINT] END AS sort_order FROM lineitem WHERE {_CASES['shown']}),
r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY level <> 'arm', reason <> 'genomic', sort_order, {_TIES}) AS rn FROM m),
p AS (SELECT * FROM r WHERE rn = 1),
s AS (SELECT 'S' || s_suppkey AS protocol, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE 'short' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'Phase I' END AS phase, s_name AS person FROM supplier),
j AS (SELECT p.*, s.* FROM p LEFT JOIN s ON protocol_no = protocol),
u AS (
  SELECT sample_id, 'trial' AS section, 'Trial Name' AS label, name AS value FROM j UNION ALL SELECT sample_id, 'trial', 'NCT ID', nct_id FROM j UNION ALL SELECT sample_id, 'trial', 'Protocol No.', protocol_no FROM j
  UNION ALL SELECT sample_id, 'trial', 'Phase', phase FROM j UNION ALL SELECT sample_id, 'trial', 'Investigator', person FROM j UNION ALL SELECT sample_id, 'trial', 'Match Level', level FROM j
  UNION ALL SELECT sample_id, 'trial', 'Trial Status', CASE WHEN status IS NULL THEN '' ELSE 'Open to accrual' END FROM j UNION ALL SELECT sample_id, 'trial', 'Match Engine', 'MatchMiner-v2' FROM j
  UNION ALL SELECT sample_id, 'match_detail', 'Cancer Type Match', l_returnflag FROM j UNION ALL SELECT sample_id, 'match_detail', 'Reason Type', reason FROM j UNION ALL SELECT sample_id, 'match_detail', 'Match Type', kind FROM j
  UNION ALL SELECT sample_id, 'genomic', 'Gene', 'G' || l_partkey FROM j UNION ALL SELECT sample_id, 'genomic', 'Variant Category', reason FROM j)
"""
_ROWS = "SELECT * FROM u WHERE value IS NOT NULL AND value <> ''"


def line_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems in the shape of trial matches."""
    none = F.lit(None).cast("string")
    order = F.when(F.col("l_linenumber") % 3 != 0, F.array(F.col("l_linenumber").cast("int"), F.col("l_quantity").cast("int")))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sample_id"),
        F.concat(F.lit("S"), "l_suppkey").alias("protocol_no"),
        F.concat(F.lit("N"), "l_partkey").alias("nct_id"),
        F.expr(_CASES["status"]).alias("trial_summary_status"),
        F.expr(_CASES["level"]).alias("match_level"),
        F.expr(_CASES["reason"]).alias("reason_type"),
        F.expr(_CASES["kind"]).alias("match_type"),
        F.col("l_returnflag").alias("cancer_type_match"),
        none.alias("code"),
        F.expr(_CASES["shown"]).alias("show_in_ui"),
        order.alias("sort_order"),
        none.alias("genomic_alteration"),
        F.concat(F.lit("G"), "l_partkey").alias("true_hugo_symbol"),
        none.alias("true_protein_change"),
        F.lit("").alias("true_cdna_change"),
        F.expr(_CASES["reason"]).alias("variant_category"),
        F.struct(*_TIES.split(", ")).alias("ord"),
    )


def protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as trials, each with its summary."""
    key = F.col("s_suppkey")
    investigator = F.struct(F.col("s_name").alias("full_name")).alias("investigator")
    summary = F.struct(F.when(key % 3 > 0, F.col("s_name")).alias("long_title"), F.lit("short").alias("short_title"), F.when(key % 2 == 0, "Phase I").alias("phase"), investigator)
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), key).alias("protocol_no"), summary.alias("_summary"))


def _labelled(rows: str) -> Column:
    """Labelled rows with their section, the last part of the column's name."""
    section = F.lit(rows.rpartition(".")[2]).alias("section")
    return F.transform(rows, lambda r: F.struct(section, r["label"].alias("label"), r["value"].alias("value")))


@query(_MATCHES + _ROWS)
def match_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled rows of each sample's primary match."""
    shown = matches.visible(line_matches(spark, sf_dir))
    best = matches.primary_match(shown, "sample_id", matches.match_priority(), ["ord"])
    context = matches.match_context(best, protocols(spark, sf_dir))
    rows = [_labelled(c) for c in ("trial", "match_detail", "genomic")]
    return context.select("sample_id", F.explode(F.flatten(F.array(*rows))).alias("r")).select("sample_id", "r.*")


@query(
    _MATCHES
    + f""", f AS (SELECT m.*, row_number() OVER (PARTITION BY sample_id, protocol_no ORDER BY {_TIES}) AS k FROM m),
o AS (SELECT f.*, row_number() OVER (PARTITION BY f.sample_id ORDER BY {', '.join('f.' + x for x in _TIES.split(', '))}) AS number FROM f JOIN p ON f.sample_id = p.sample_id WHERE f.k = 1 AND f.protocol_no <> p.protocol_no),
x AS (SELECT o_orderkey::VARCHAR AS sample_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS first_name, o_orderstatus || ', x' AS sites, o_custkey::VARCHAR AS mrn FROM orders),
a AS (SELECT sample_id, section, label, value FROM u UNION ALL SELECT sample_id, 'patient_header', 'First Name', first_name FROM x UNION ALL SELECT sample_id, 'patient_detail', 'Metastasis Sites', sites FROM x
  UNION ALL SELECT sample_id, 'patient_detail', 'MRN', mrn FROM x UNION ALL SELECT sample_id, 'other', number::VARCHAR, protocol_no || '|' || nct_id || '|' || level || '|' || kind || '||matchminer' FROM o)
SELECT * FROM a WHERE value IS NOT NULL AND value <> ''"""
)
def report_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report table as rows: patient, primary match and other matches of each sample."""
    key = F.col("o_orderkey")
    patient = F.struct(F.when(key % 2 == 0, F.col("o_orderpriority")).alias("first_name"), F.array("o_orderstatus", F.lit("x")).alias("metastasis_sites"), F.col("o_custkey").cast("string").alias("mrn"))
    extras = table(spark, sf_dir, "orders").select(key.cast("string").alias("sample_id"), patient.alias("patient"), F.array(F.lit("r")).alias("reports"))
    report = matches.report_context(line_matches(spark, sf_dir), protocols(spark, sf_dir), extras)
    fields = ("protocol_no", "nct_id", "match_level", "match_type", "genomic_alteration", "source")
    other = F.transform("other_matches", lambda r: F.struct(F.lit("other").alias("section"), r["number"].cast("string").alias("label"), F.concat_ws("|", *[r[f] for f in fields]).alias("value")))
    parts = [_labelled(c) for c in ("patient_header", "patient_detail", "primary_match.trial", "primary_match.match_detail", "primary_match.genomic")] + [other]
    none = F.array().cast("array<struct<section:string,label:string,value:string>>")
    return report.select("sample_id", F.explode(F.flatten(F.array(*[F.coalesce(x, none) for x in parts]))).alias("r")).select("sample_id", "r.*")
