"""Patient queries: customers as patients, orders as reports, lineitems as findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import patients
from .registry import query, table


@query(
    """SELECT doc_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN (CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END) END, 'tempus') AS source FROM documents LEFT JOIN labels USING (doc_id)"""
)
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("report_uuid"), F.col("doc_id").alias("ord"), F.when(F.col("quality") == 1, "good").otherwise("poor").alias("source")).filter("report_uuid % 3 <> 0")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("report_uuid"), F.lit("tempus").alias("default_source"))
    return patients.with_source(docs, labels).select(F.col("report_uuid").alias("doc_id"), "source")


@query(
    """WITH f AS (SELECT user_id, arg_min(value, event_id) AS first_value FROM events WHERE value > 50 GROUP BY user_id)
SELECT e.user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest, round(any_value(f.first_value), 6) AS first_value FROM events e LEFT JOIN f ON e.user_id = f.user_id GROUP BY e.user_id"""
)
def latest_and_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    latest = patients.latest_date(events, "user_id", "ts")
    shown = F.when(F.col("value") > 50, F.col("value").cast("decimal(38,12)").cast("string"))
    findings = events.select("user_id", F.lit("tmb").alias("gene"), shown.alias("result_summary"), F.col("event_id").alias("ord"))
    first = patients.first_parseable(findings, "user_id")
    return latest.join(first, "user_id", "left").select("user_id", F.date_format("report_date", "yyyy-MM-dd HH:mm:ss").alias("latest"), F.round("tmb", 6).alias("first_value"))


@query(
    """WITH l AS (SELECT l_orderkey, string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY l_orderkey)
SELECT c_custkey, count(o_orderkey) AS n_reports, coalesce(string_agg(o_orderkey || '[' || coalesce(items, '') || ']', ';' ORDER BY o_orderkey), '') AS reports
FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY c_custkey"""
)
def nested_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pt_uuid"), F.lit(None).cast("string").alias("mrn"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pt_uuid"), F.col("o_orderkey").alias("report_uuid"))
    none = F.lit(None).cast("string")
    metadata = orders.select("*", F.col("report_uuid").alias("ord"), F.col("report_uuid").cast("string").alias("source"), none.alias("test_name"), none.alias("accession_no"), none.alias("physician"), F.lit(None).cast("date").alias("date_completed"))
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("report_uuid"))
    gene = F.concat_ws(":", "l_partkey", "l_suppkey")
    findings = lines.select("pt_uuid", "report_uuid", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), gene.alias("gene"), none.alias("protein"), none.alias("nucleotide"), none.alias("variant_type"), none.alias("result_summary"), F.create_map().cast("map<string,string>").alias("raw"))
    extras = patients.nested_reports(people, metadata, findings)
    shown = F.transform("reports", lambda r: F.concat(r["source"], F.lit("["), F.array_join(F.transform(r["findings"], lambda f: f["gene"]), ","), F.lit("]")))
    return extras.select(F.col("sample_id").cast("long").alias("c_custkey"), F.size("reports").cast("long").alias("n_reports"), F.array_join(shown, ";").alias("reports"))


_KINDS = "CASE l_linenumber WHEN 1 THEN 'SNV' WHEN 2 THEN 'fusion' WHEN 3 THEN 'cnv' WHEN 4 THEN 'hla' WHEN 5 THEN 'tumor_biomarker' WHEN 6 THEN 'negative' ELSE 'odd' END"


@query(
    f"""WITH f AS (SELECT o_custkey, l_partkey, {_KINDS} AS vt, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey::VARCHAR AS sample_id, 'G' || l_partkey AS gene, CASE vt WHEN 'fusion' THEN 'SV' WHEN 'cnv' THEN 'CNV' ELSE 'MUTATION' END AS category, vt = 'negative' AS wildtype,
CASE WHEN vt = 'fusion' THEN 'R' END AS partner, CASE WHEN vt = 'cnv' THEN nullif(l_returnflag, 'N') END AS cnv_call, count(*) AS n
FROM f WHERE vt IN ('SNV', 'fusion', 'cnv', 'negative') GROUP BY ALL"""
)
def clinical_genomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pt_uuid"), F.lit("").alias("mrn"))
    kind = F.when(F.col("l_linenumber") > 6, "odd").otherwise(F.element_at(F.array(*map(F.lit, ("SNV", "fusion", "cnv", "hla", "tumor_biomarker", "negative"))), F.least("l_linenumber", F.lit(6))))
    plain = F.concat(F.lit("G"), "l_partkey")
    gene = F.when(kind == "fusion", F.concat(plain, F.lit("::R"))).when(kind == "tumor_biomarker", "tmb").otherwise(plain)
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.lit(None).cast("string")
    findings = lines.select(F.col("o_custkey").alias("pt_uuid"), gene.alias("gene"), kind.alias("variant_type"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("result_summary"), none.alias("protein"), F.lit("NA").alias("nucleotide"))
    genomic, _ = patients.genomic_rows(people, findings)
    names = {"SAMPLE_ID": "sample_id", "TRUE_HUGO_SYMBOL": "gene", "VARIANT_CATEGORY": "category", "WILDTYPE": "wildtype", "RIGHT_PARTNER_GENE": "partner", "CNV_CALL": "cnv_call"}
    rows = genomic.select(*[F.col(a).alias(b) for a, b in names.items()])
    return rows.groupBy(*names.values()).agg(F.count("*").alias("n"))


def _findings(spark: SparkSession, sf_dir: str, gene, kind, summary, protein=None) -> DataFrame:
    """Order lines as findings of the order's customer."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.lit(None).cast("string")
    ord = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return lines.select(F.col("o_custkey").alias("pt_uuid"), F.col("l_orderkey").alias("report_uuid"), gene.alias("gene"), (none if protein is None else protein).alias("protein"), none.alias("nucleotide"), kind.alias("variant_type"), summary.alias("result_summary"), ord.alias("ord"))


@query(
    """WITH f AS (SELECT o_custkey, CASE WHEN l_linenumber % 3 = 1 THEN l_quantity END AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY l_linenumber % 3 <> 1, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY o_custkey)
SELECT CASE c_custkey % 4 WHEN 0 THEN c_custkey::VARCHAR ELSE 'M' || c_custkey END AS sample_id, c_mktsegment AS diagnosis, c_name AS raw_diagnosis, CASE WHEN c_custkey % 5 > 0 THEN strftime(DATE '1950-01-01' + c_custkey::INTEGER, '%Y-%m-%d') END AS birth_date,
CASE c_custkey % 3 WHEN 0 THEN 'deceased' ELSE 'alive' END AS vital_status, CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS gender, f.v AS tmb, strftime(m.d, '%Y-%m-%d') AS report_date
FROM customer LEFT JOIN f ON f.o_custkey = c_custkey AND r = 1 LEFT JOIN m ON m.o_custkey = c_custkey"""
)
def clinical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as patients, orders as their reports, order lines as findings (a third of them tumour burdens)."""
    key = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(
        key.alias("pt_uuid"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("M"), key)).alias("mrn"),
        F.col("c_mktsegment").alias("oncotree_primary_diagnosis"),
        F.col("c_name").alias("primary_dx"),
        F.when(key % 5 > 0, F.date_add(F.lit("1950-01-01").cast("date"), key.cast("int"))).alias("dob"),
        F.when(key % 3 == 0, "deceased").when(key % 3 == 1, "").alias("vital_status"),
        F.when(key % 3 == 0, " MALE").when(key % 3 == 1, "f").otherwise("other").alias("sex"),
    )
    metadata = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pt_uuid"), F.col("o_orderdate").cast("date").alias("date_completed"))
    burden = F.concat(F.lit("TMB-Low ("), F.col("l_quantity"), F.lit(")"))
    findings = _findings(spark, sf_dir, F.lit("tmb"), F.lit("tumor_biomarker"), F.when(F.col("l_linenumber") % 3 == 1, burden).otherwise("not done"))
    rows = patients.clinical_rows(people, metadata, findings)
    names = ("sample_id", "diagnosis", "raw_diagnosis", "birth_date", "vital_status", "gender", "tmb", "report_date")
    return rows.drop("_updated").toDF(*names)


_SIGNATURES = "CASE l_partkey % 6 WHEN 0 THEN 'msi' WHEN 1 THEN 'POLE' WHEN 2 THEN 'APOBEC' WHEN 3 THEN 'Smoking' WHEN 4 THEN 'MLH1' ELSE 'EGFR' END"
_SUMMARIES = "CASE l_suppkey % 5 WHEN 0 THEN 'MSI-H' WHEN 1 THEN 'unstable' WHEN 2 THEN 'Loss of MLH1, stable' WHEN 3 THEN 'seen' ELSE '' END"


@query(
    f"""WITH f AS (SELECT {_SIGNATURES} AS gene, {_SUMMARIES} AS s, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS protein FROM lineitem),
g AS (SELECT gene, protein, CASE WHEN gene IN ('msi', 'MLH1') THEN (CASE WHEN s IN ('MSI-H', 'Loss of MLH1, stable') THEN 'Deficient (MMR-D / MSI-H)' WHEN s = 'unstable' THEN 'Proficient (MMR-P / MSS)' ELSE s END) END AS mmr,
CASE WHEN gene = 'POLE' THEN s END AS pole, CASE WHEN gene = 'APOBEC' THEN s END AS apobec, CASE WHEN gene = 'Smoking' THEN s END AS tobacco FROM f)
SELECT gene, protein, mmr, pole, apobec, tobacco, count(*) AS n FROM g GROUP BY ALL"""
)
def signature_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tumour biomarkers: the status columns by gene, and proteins that aren't NA."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pt_uuid"), F.lit("").alias("mrn"))
    protein = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).otherwise("NA")
    findings = _findings(spark, sf_dir, F.expr(_SIGNATURES), F.lit(" tumor_biomarker"), F.expr(_SUMMARIES), protein)
    genomic, _ = patients.genomic_rows(people, findings)
    names = {"TRUE_HUGO_SYMBOL": "gene", "TRUE_PROTEIN_CHANGE": "protein", "MMR_STATUS": "mmr", "POLE_STATUS": "pole", "APOBEC_STATUS": "apobec", "TOBACCO_STATUS": "tobacco"}
    return genomic.select(*[F.col(a).alias(b) for a, b in names.items()]).groupBy(*names.values()).agg(F.count("*").alias("n"))


@query("SELECT array_to_string(list_sort(list_distinct(list('odd ' || l_linestatus))), ',') AS variant_types FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber > 2")
def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pt_uuid"), F.lit("").alias("mrn"))
    kind = F.when(F.col("l_linenumber") > 2, F.concat(F.lit("odd "), "l_linestatus")).otherwise("SNV")
    _, rejects = patients.genomic_rows(people, _findings(spark, sf_dir, F.lit("G"), kind, F.lit("")))
    return patients.unknown_types(rejects).select(F.array_join("variant_types", ",").alias("variant_types"))


@query(
    """WITH u AS (SELECT 'tempus' AS source, l_orderkey AS report, 'raw_flag' AS name, l_returnflag AS value FROM lineitem UNION ALL SELECT 'tempus', l_orderkey, 'raw_status', nullif(l_linestatus, 'O') FROM lineitem
UNION ALL SELECT 'tumor_biomarkers', o_orderkey, 'raw_priority', o_orderpriority FROM orders)
SELECT source, name, value, count(*) AS n, count(DISTINCT report) AS n_reports FROM u WHERE value IS NOT NULL GROUP BY ALL"""
)
def findings_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sheets with other raw columns in one table."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("report_uuid"), F.concat(F.lit("G"), "l_partkey").alias("protein"), F.col("l_returnflag").alias("raw_flag"), F.nullif(F.col("l_linestatus"), F.lit("O")).alias("raw_status"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_uuid"), F.col("o_orderpriority").alias("raw_priority"))
    both = patients.united_findings({"tempus_findings": lines, "tumor_biomarkers": orders})
    rows = both.select(F.col("default_source").alias("source"), "report_uuid", F.explode("raw").alias("name", "value"))
    return rows.groupBy("source", "name", "value").agg(F.count("*").alias("n"), F.count_distinct("report_uuid").alias("n_reports"))
