"""Files: the driver's tables written in the shapes that the sources read, and read back."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean
from ..operators import annotate, trials
from ..sources import collections, registry, rejects, sheets
from ..sources.shared import shared_dir
from ..streaming import incremental
from .registry import query, table


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


def registry_id(key: Column) -> Column:
    """NCT and eight digits; longer numbers are cut, as SQL's lpad does (a format only pads them)."""
    return F.concat(F.lit("NCT"), F.lpad(key.cast("string"), 8, "0"))


@query(
    """SELECT '2020.' || s_suppkey AS trial_key, CASE WHEN s_suppkey % 2 = 0 THEN 'open to accrual' ELSE 'ODD' END AS status, 'amc' AS entity, CASE s_suppkey % 3 WHEN 0 THEN 'Phase I' WHEN 1 THEN 'N/A' END AS phase,
CASE WHEN s_suppkey % 4 = 0 THEN 'Pediatric' ELSE 'Adult' END AS age, s_name || '|Liver' AS keywords, CASE WHEN s_suppkey % 4 = 0 THEN '{"clinical":{"age_numerical":"<18"}}' ELSE '{"clinical":{"age_numerical":">=18"}}' END
|| CASE WHEN s_suppkey % 5 = 0 THEN '|{"clinical":{"oncotree_primary_diagnosis":"Breast"}}' ELSE '' END AS match FROM supplier"""
)
def registry_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registry protocols: to XML, back, and into the common trial shape."""
    key = F.col("s_suppkey")
    values = {
        "NO": F.concat(F.lit("2020."), key),
        "NCT_NUMBER": F.lit("NCT00000001"),
        "STATUS": F.when(key % 2 == 0, "OPEN TO ACCRUAL").otherwise("ODD"),
        "AGE_GROUP": F.when(key % 4 == 0, "Children").otherwise("Adults"),
        "PHASE": F.when(key % 3 == 0, "I").when(key % 3 == 1, "N/A"),
        "DISEASE_SITE": F.concat("s_name", F.lit("; Liver")),
    }
    level = [F.lit(x).alias(f"CAT{i}") for i, x in ((1, "Breast"), (2, "x"), (3, "y"))]
    categories = F.struct(F.when(key % 5 == 0, F.array(F.struct(*level))).alias("CATEGORY"))
    rows = table(spark, sf_dir, "supplier").select(*[c.alias(tag) for tag, c in values.items()], categories.alias("CATEGORYS"))
    path = folder(spark)
    rows.write.format("xml").option("rowTag", "PROTOCOL").option("rootTag", "ALL").save(path)
    docs = trials.normalize_registry(registry.read_registry_xml(spark, path), spark)
    s = F.col("_summary")
    return docs.select("trial_key", "status", "entity", s["phase"].alias("phase"), s["age"].alias("age"), F.array_join(s["disease_keywords"], "|").alias("keywords"), F.array_join(F.col("treatment_list.step")[0]["match"], "|").alias("match"))


def _studies(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Parts as public studies in three shapes, a record a line."""
    key = F.col("p_partkey")
    id, phases = registry_id(key), F.array(F.lit("PHASE1"), F.lit("PHASE2"))
    section = F.struct(
        F.struct(id.alias("nctId"), F.col("p_name").alias("briefTitle")).alias("identificationModule"),
        F.struct(F.lit("RECRUITING").alias("overallStatus")).alias("statusModule"),
        F.struct(phases.alias("phases")).alias("designModule"),
        F.struct(F.lit("FEMALE").alias("sex"), F.concat(F.col("p_size"), F.lit(" Years")).alias("minimumAge")).alias("eligibilityModule"),
    )
    parts = table(spark, sf_dir, "part")
    flat = parts.filter(key % 3 == 0).select(id.alias("nct_id"), F.col("p_name").alias("brief_title"), F.lit("RECRUITING").alias("overall_status"), phases.alias("phases"), F.lit("FEMALE").alias("sex"), F.concat(F.col("p_size"), F.lit(" Years")).alias("minimum_age"))
    single = parts.filter(key % 3 == 1).select(section.alias("protocolSection"))
    many = parts.filter(key % 3 == 2).groupBy("p_brand").agg(F.collect_list(F.struct(section.alias("protocolSection"))).alias("studies")).drop("p_brand")
    for df in (flat, single, many):
        collections.write_collection(df, f"{path}/{uuid.uuid4().hex}", "jsonl")


@query("SELECT 'NCT' || lpad(p_partkey::VARCHAR, 8, '0') AS trial_key, p_name AS title, 'open to accrual' AS status, 'Phase I/II' AS phase, '{\"clinical\":{\"age_numerical\":\">=' || p_size || '\",\"gender\":\"Female\"}}' AS match FROM part")
def studies_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    _studies(spark, sf_dir, path)
    docs = trials.normalize_studies(registry.read_studies(spark, f"{path}/*", "jsonl"))
    return docs.select("trial_key", F.col("_summary.short_title").alias("title"), "status", F.col("_summary.phase").alias("phase"), F.array_join(F.col("treatment_list.step")[0]["match"], "|").alias("match"))


@query(
    """WITH s AS (SELECT s_name, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'odd' ELSE 'NCT' || lpad((s_suppkey * CASE s_suppkey % 4 WHEN 2 THEN 1 ELSE 1000000 END)::VARCHAR, 8, '0') END AS id FROM supplier),
p AS (SELECT 'NCT' || lpad(p_partkey::VARCHAR, 8, '0') AS id, p_name FROM part)
SELECT s.id AS key, s_name AS site, p_name AS title, 'found' AS state FROM s JOIN p USING (id) UNION ALL SELECT id, s_name, NULL, 'no study with this id' FROM s WHERE id <> 'odd' AND id NOT IN (SELECT id FROM p)
UNION ALL SELECT id, s_name, NULL, 'malformed nct_id' FROM s WHERE id = 'odd'"""
)
def site_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a site's sheet, enriched from parts as studies; rows without an id are skipped."""
    path, key = folder(spark), F.col("s_suppkey")
    id = F.when(key % 4 == 1, "odd").when(key % 4 == 2, F.regexp_replace(registry_id(key), "NCT", " nct ")).when(key % 4 == 3, registry_id(key * 1_000_000))
    names = [F.when(F.lit(c == "study_name"), F.col("s_name")).when(F.lit(c == "nct_id"), id).alias(c) for c in schemas.SPARROW]
    table(spark, sf_dir, "supplier").select(*names).write.option("header", True).csv(f"{path}/sheet")
    _studies(spark, sf_dir, f"{path}/studies")
    sheet, bad = sheets.read_site_sheet_sparrow(spark, f"{path}/sheet")
    found, missing = trials.normalize_site(sheet, registry.read_studies(spark, f"{path}/studies/*", "jsonl"), "sparrow")
    good = found.select(F.col("nct_id").alias("key"), F.get_json_object("_raw", "$.site.study_name").alias("site"), F.col("_summary.short_title").alias("title"), F.lit("found").alias("state"))
    rejects = missing.unionByName(bad).select(F.col("nct_id").alias("key"), F.col("study_name").alias("site"), F.lit(None).cast("string").alias("title"), F.col("reason").alias("state"))
    return good.unionByName(rejects)


@query(
    """WITH s AS (SELECT s_name, CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'odd ' || s_suppkey ELSE 'NCT' || lpad(s_suppkey::VARCHAR, 8, '0') END AS id FROM supplier),
p AS (SELECT 'NCT' || lpad(p_partkey::VARCHAR, 8, '0') AS id, p_name FROM part)
SELECT s.id AS key, s_name AS site, p_name AS title, CASE WHEN p.id IS NULL THEN 'no study with this id' ELSE 'found' END AS state FROM s LEFT JOIN p USING (id) WHERE s.id IS NOT NULL"""
)
def west_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the other site's sheet, whose ids aren't checked, enriched from parts as studies; rows without an id are skipped."""
    path, key = folder(spark), F.col("s_suppkey")
    id = F.when(key % 3 == 1, F.concat(F.lit("odd "), key)).when(key % 3 == 2, registry_id(key))
    title, number = schemas.WEST[1 - schemas.WEST.index("nct_id")], "nct_id"
    names = [F.when(F.lit(c == title), F.col("s_name")).when(F.lit(c == number), id).alias(c) for c in schemas.WEST]
    table(spark, sf_dir, "supplier").select(*names).write.option("header", True).csv(f"{path}/sheet")
    _studies(spark, sf_dir, f"{path}/studies")
    found, missing = trials.normalize_site(sheets.read_site_sheet_west(spark, f"{path}/sheet"), registry.read_studies(spark, f"{path}/studies/*", "jsonl"), "west")
    good = found.select(F.col("nct_id").alias("key"), F.get_json_object("_raw", f"$.site.{title}").alias("site"), F.col("_summary.short_title").alias("title"), F.lit("found").alias("state"))
    return good.unionByName(missing.select(F.col("nct_id").alias("key"), F.col(title).alias("site"), F.lit(None).cast("string").alias("title"), F.col("reason").alias("state")))


@query(
    """SELECT 'study' AS kind, CASE WHEN p_partkey % 7 = 0 THEN 'malformed' WHEN p_partkey % 7 = 1 THEN 'no study' ELSE 'good' END AS outcome, count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM part GROUP BY 2
UNION ALL SELECT 'match', CASE WHEN c_custkey % 5 = 0 THEN 'malformed' WHEN c_custkey % 5 = 1 THEN 'no sample' ELSE 'good' END, count(*), sum(c_custkey)::BIGINT FROM customer GROUP BY 2
UNION ALL SELECT 'protocol', CASE WHEN s_suppkey % 4 = 0 THEN 'malformed' WHEN s_suppkey % 4 = 1 THEN 'no number' ELSE 'good' END, count(*), sum(s_suppkey)::BIGINT FROM supplier GROUP BY 2"""
)
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as studies, customers as matches and suppliers as protocols, some of them broken or without a name: what the readers keep and what is rejected."""
    path = folder(spark)

    def lines(name: str, key: str, each: int, good: str, empty: str, broken: str, folder: str) -> None:
        k = F.col(key)
        fill = lambda text: F.concat(*[x for i, part in enumerate(text.split("@")) for x in ((k.cast("string"),) if i else ()) + (F.lit(part),)])
        text = F.when(k % each == 0, fill(broken)).when(k % each == 1, fill(empty)).otherwise(fill(good))
        table(spark, sf_dir, name).select(text.alias("value")).write.text(f"{path}/{folder}")

    lines("part", "p_partkey", 7, '{"nct_id":"@","brief_title":"t"}', '{"brief_title":"@"}', '{"nct_id":"@', "studies")
    lines("customer", "c_custkey", 5, '{"sample_id":"@"}', '{"sample_id":"","protocol_no":"@"}', '@ {"sample_id"', "matches")
    lines("supplier", "s_suppkey", 4, "<PROTOCOL><NO>@</NO><STATUS>OPEN</STATUS></PROTOCOL>", "<PROTOCOL><STATUS>@</STATUS></PROTOCOL>", "<PROTOCOL><NO>@</STATUS></PROTOCOL>", "protocols")
    good = {
        "study": registry.read_studies(spark, f"{path}/studies", "jsonl").select(F.col("nct_id").alias("key")),
        "match": collections.read_matches(spark, f"{path}/matches", "jsonl").filter(clean.filled(F.col("sample_id")).isNotNull()).select(F.col("sample_id").alias("key")),
        "protocol": registry.read_registry_xml(spark, f"{path}/protocols").filter("protocol_no IS NOT NULL").select(F.col("protocol_no").alias("key")),
    }
    bad = {"study": rejects.study_rejects(spark, f"{path}/studies", "jsonl"), "match": rejects.match_rejects(spark, f"{path}/matches", "jsonl"), "protocol": rejects.registry_rejects(spark, f"{path}/protocols")}
    rows = None
    for kind, kept in good.items():
        number = F.regexp_extract(F.col("record"), r"([0-9]+)", 1)
        both = kept.withColumn("outcome", F.lit("good")).union(bad[kind].select(number, "reason"))
        both = both.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(F.col("key").cast("long")).alias("keys")).select(F.lit(kind).alias("kind"), "outcome", "n", "keys")
        rows = both if rows is None else rows.union(both)
    return rows


@query(
    """WITH o AS (SELECT * FROM orders WHERE o_custkey % 7 > 0),
f AS (SELECT o_custkey, l_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'tempus' ELSE o_orderpriority END AS source FROM lineitem JOIN o ON l_orderkey = o_orderkey)
SELECT source, 'finding' AS kind, count(*) AS n, count(DISTINCT o_custkey) AS n_patients FROM f GROUP BY source
UNION ALL SELECT 'pt_general', 'reject', count(*), 0 FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT 'report_metadata', 'reject', count(*), 0 FROM orders WHERE o_orderkey % 5 = 0"""
)
def patient_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, orders and lineitems as sheets; some patients have no number, some reports no source."""
    path, key = folder(spark), F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(F.when(key % 7 > 0, key.cast("string")).otherwise("none").alias("pt_uuid"), F.col("c_name").alias("last_name"), F.lit("3/4/1960").alias("dob"))
    source = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders")
    metadata = orders.select(F.col("o_orderkey").alias("report_uuid"), F.col("o_custkey").alias("pt_uuid"), source.alias("source"), F.date_format("o_orderdate", "yyyy-M-d").alias("date_completed"))
    findings = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("pt_uuid"), F.col("l_orderkey").alias("report_uuid"), F.concat(F.lit("G"), "l_partkey").alias("gene"), F.lit("SNV").alias("variant_type"), F.col("l_returnflag").alias("raw_flag"))
    for name, df in (("pt_general", people), ("report_metadata", metadata), ("tempus_findings", findings)):
        df.write.option("header", True).csv(f"{path}/{name}.csv")
    data = sheets.read_patient_sheets(spark, path)
    own = data["findings"].groupBy("source").agg(F.lit("finding").alias("kind"), F.count("*").alias("n"), F.count_distinct("pt_uuid").alias("n_patients"))
    return own.union(data["rejects"].groupBy("sheet").agg(F.lit("reject"), F.count("*"), F.lit(0).cast("long")))


@query(
    """SELECT route AS part, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, bit_xor(o_orderkey * o_orderkey) AS marks FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'changed' WHEN 1 THEN 'deleted' ELSE 'unchanged' END AS route FROM orders) GROUP BY route
UNION ALL SELECT CASE o_orderkey % 2 WHEN 0 THEN 'high_confidence' ELSE 'needs_curation' END, count(*), sum(o_orderkey)::BIGINT, bit_xor(o_orderkey * o_orderkey) FROM orders GROUP BY 1
UNION ALL SELECT 'report', count(*), sum(o_orderkey)::BIGINT, bit_xor(o_orderkey * o_orderkey) FROM orders
UNION ALL SELECT 'open orders', count(*), sum(o_orderkey)::BIGINT, bit_xor(o_orderkey * o_orderkey) FROM orders WHERE o_orderstatus = 'O'"""
)
def sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through the partitioned sinks and a report of two sections, read back."""
    path, key = folder(spark), F.col("o_orderkey")
    tier = F.when(key % 2 == 0, "high_confidence").otherwise("needs_curation")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(key % 3 == 0, "changed").when(key % 3 == 1, "deleted").otherwise("unchanged").alias("route"), tier.alias("tier"))
    collections.write_diff(orders, f"{path}/diff")
    collections.write_tiers(orders, f"{path}/tiers")
    collections.write_sectioned_report({"All orders": orders.select("o_orderkey"), "Open: orders": orders.filter("o_orderstatus = 'O'").select("o_orderkey")}, f"{path}/report")
    marks = [F.count("*").alias("n"), F.sum(key).alias("keys"), F.bit_xor(key * key).alias("marks")]
    diff = spark.read.parquet(f"{path}/diff").groupBy(F.col("route").alias("part")).agg(*marks)
    tiers = spark.read.parquet(f"{path}/tiers").groupBy(F.col("tier").alias("part")).agg(*marks)
    out = diff.union(tiers)
    for part, section in (("report", "1_all_orders"), ("open orders", "2_open__orders")):
        read = spark.read.schema("o_orderkey long").option("header", True).csv(f"{path}/report/{section}")
        out = out.union(read.agg(*marks).select(F.lit(part).alias("part"), "n", "keys", "marks"))
    return out


@query(
    """SELECT 'match' AS kind, l_orderkey::VARCHAR AS name, count(*) AS n FROM lineitem GROUP BY l_orderkey UNION ALL SELECT DISTINCT 'gene', upper(p_type), 1 FROM part
UNION ALL SELECT 'trial', s_name, 1 FROM supplier"""
)
def collections_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches flat and in envelopes, a gene vocabulary and trials: written, and read as collections."""
    path = folder(spark)
    match = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"), F.array(F.col("l_linenumber").cast("int")).alias("sort_order"), (F.col("l_suppkey") % 2 == 0).alias("even"))
    flat = match.filter("even").drop("even")
    packed = match.filter("NOT even").groupBy("sample_id").agg(F.collect_list(F.struct("sample_id", "sort_order")).alias("trial_match")).select("trial_match")
    collections.write_collection(flat, f"{path}/matches/flat", "jsonl")
    collections.write_collection(packed, f"{path}/matches/packed", "jsonl")
    genes = table(spark, sf_dir, "part").select(F.lower("p_type").alias("name"))
    collections.write_collection(genes, f"{path}/genes", "jsonl")
    master = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("trial_key"))
    collections.write_collection(master, f"{path}/trials", "parquet")
    found = collections.read_matches(spark, f"{path}/matches/*", "jsonl").groupBy(F.col("sample_id").alias("name")).agg(F.count("*").alias("n"))
    known = collections.read_gene_kb(spark, f"{path}/genes", "jsonl").select(F.lit("gene").alias("kind"), "name", F.lit(1).cast("long").alias("n"))
    read = collections.read_trials(spark, f"{path}/trials", "parquet").unionByName(collections.read_trials(spark, f"{path}/none"))
    return found.select(F.lit("match").alias("kind"), "name", "n").union(known).union(read.select(F.lit("trial"), "trial_key", F.lit(1).cast("long")))


@query("SELECT md5('inclusion:' || text) AS cache_key, any_value(CASE WHEN text = '' THEN NULL ELSE to_json(lower(string_split(text, ' ')[1]))::VARCHAR END) AS answer FROM documents GROUP BY 1")
def annotation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of texts to annotate (a toy function: the first word in lower case), answered once each into the store."""
    path = folder(spark)
    docs = table(spark, sf_dir, "documents")
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf_dir}/documents.parque*")
    items = stream.select(clean.cache_key(F.lit("inclusion"), F.col("text")).alias("cache_key"), "text")
    store = collections.SuggestionStore(spark, f"{path}/store")

    def first_word(texts: pd.Series) -> pd.Series:
        import json

        return texts.map(lambda t: json.dumps(t.split(" ")[0].lower(), ensure_ascii=False) if t else None)

    for _ in range(2):  # the second run finds nothing new
        incremental.annotate_stream(items, store, first_word, f"{path}/checkpoint").awaitTermination()
    return annotate.latest(store.read()).select("cache_key", F.col("value_json").alias("answer"))
