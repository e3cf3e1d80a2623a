"""Curation queries: documents as texts to annotate, order lines as match nodes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import annotate, curate, nodes, trials, vocab
from .registry import query, table


def _worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text", clean.cache_key(F.lit("inclusion"), F.col("text")).alias("cache_key"))


def _store(work: DataFrame) -> DataFrame:
    """Answers for a third of the documents, some of them null."""
    some = work.filter("doc_id % 3 = 0").select("cache_key", F.when(F.col("doc_id") % 2 == 0, F.to_json(F.array(F.upper("source")))).alias("value_json"), F.col("doc_id").alias("ord"))
    return some.select("cache_key", "value_json", F.col("value_json").isNull().alias("is_null"), "ord")


_CACHE = "WITH w AS (SELECT doc_id, source, text, md5('inclusion:' || text) AS k FROM documents), s AS (SELECT DISTINCT k FROM w WHERE doc_id % 3 = 0)"


@query(_CACHE + "SELECT w.source, count(*) AS n_items, count(s.k) AS n_cached FROM w LEFT JOIN s ON w.k = s.k GROUP BY w.source")
def cache_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _worklist(spark, sf_dir)
    return annotate.progress(annotate.look_up(work, _store(work)), "source")


@query(_CACHE + "SELECT DISTINCT w.k AS cache_key FROM w WHERE k NOT IN (SELECT k FROM s)")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _worklist(spark, sf_dir)
    return annotate.misses(work, _store(work)).select("cache_key")


@query(_CACHE + "SELECT doc_id, CASE WHEN w.k IN (SELECT k FROM s) THEN 'stored' ELSE lower(string_split(text, ' ')[1]) END AS answer FROM w")
def annotate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misses through a toy function (the first word in lower case), appended to the store and joined again."""
    work = _worklist(spark, sf_dir)
    store = _store(work).withColumn("value_json", F.lit("stored"))

    def first_word(texts: pd.Series) -> pd.Series:
        return texts.str.split(" ").str[0].str.lower()

    answers = annotate.annotate(annotate.misses(work, store), first_word, ord=10**9)
    return annotate.look_up(work, store.unionByName(answers)).select("doc_id", F.col("value_json").alias("answer"))


@query(
    """WITH b AS (SELECT DISTINCT upper(unnest(string_split(replace(text, 'ß', 's'), ' '))) AS w FROM benchmark), d AS (SELECT doc_id, unnest(string_split(replace(text, 'ß', 's'), ' ')) AS w FROM documents)
SELECT doc_id, count(*) AS n_words, count(b.w) AS n_known FROM d LEFT JOIN b ON upper(d.w) = b.w GROUP BY doc_id"""
)
def kb_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words known from the benchmark (ß has two upper cases, so it is written s)."""
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.replace(F.col("text"), F.lit("ß"), F.lit("s")), " ")).alias("name"))
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.replace(F.col("text"), F.lit("ß"), F.lit("s")), " ")).alias("word"))
    return annotate.flag_known(words, "word", known).groupBy("doc_id").agg(F.count("*").alias("n_words"), F.count_if("in_kb").alias("n_known"))


def _order_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, node): an ``and`` of a genomic leaf and an ``or`` of the order's return flags as diagnoses."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"))
    genomic = F.struct(F.struct(F.lit("G1").alias("hugo_symbol")).alias("genomic"))
    node = F.concat(F.lit('{"and":['), F.to_json(genomic), F.lit(","), nodes.diagnoses_to_node(F.col("flags")), F.lit("]}"))
    return lines.select("l_orderkey", node.alias("node"))


@query(
    """WITH f AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem), g AS (SELECT l_orderkey, count(*) AS k FROM f GROUP BY l_orderkey)
SELECT l_orderkey, k AS n_clinical, 1::BIGINT AS n_genomic, CASE WHEN k > 1 THEN 2 ELSE 1 END::BIGINT AS n_inner, true AS has_diagnosis FROM g"""
)
def node_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = nodes.flatten_nodes(_order_trees(spark, sf_dir), "l_orderkey", "node")
    counts = {"n_clinical": F.col("op") == "clinical", "n_genomic": F.col("op") == "genomic", "n_inner": F.col("op").isin("and", "or")}
    return flat.groupBy("l_orderkey").agg(*[F.count_if(c).alias(n) for n, c in counts.items()], F.bool_or(nodes.is_diagnosis()).alias("has_diagnosis"))


@query(
    """WITH f AS (SELECT DISTINCT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'Returned' END AS d FROM lineitem),
g AS (SELECT l_orderkey, count(DISTINCT d) AS k, bool_or(d IS NULL) AS gone, string_agg('{"clinical":{"oncotree_primary_diagnosis":"' || d || '"}}', ',' ORDER BY d) AS leaves FROM f GROUP BY l_orderkey)
SELECT l_orderkey, '{"and":[{"genomic":{"hugo_symbol":"G1"}}' || CASE WHEN k = 0 THEN '' WHEN k + gone::INT = 1 THEN ',' || leaves ELSE ',{"or":[' || leaves || ']}' END || ']}' AS node FROM g"""
)
def node_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = spark.range(1).select(F.lit("A").alias("name"))
    return nodes.validate_nodes(_order_trees(spark, sf_dir), vocabulary, "l_orderkey", "node", {"R": "Returned", "N": None})


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber::BIGINT AS nth, l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS node FROM lineitem UNION ALL SELECT o_orderkey, 1000, 0, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
f AS (SELECT l_orderkey, node, min(nth * 10000000 + l_partkey) AS seen FROM s WHERE node IS NOT NULL GROUP BY 1, 2)
SELECT l_orderkey, count(*) AS n_suggestions, string_agg(node, ',' ORDER BY nth, l_partkey, node) AS united, (SELECT string_agg(node, ',' ORDER BY seen) FROM f WHERE f.l_orderkey = s.l_orderkey) AS names FROM s GROUP BY l_orderkey"""
)
def curate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line suggestions and one of the order, nulls dropped, and the distinct names in order."""
    node = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").cast("int").alias("a"), F.col("l_partkey").alias("b"), node.alias("c")).alias("nth"), node.alias("suggested_node"))
    orders = table(spark, sf_dir, "orders").join(lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    title = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.struct(F.lit(1000).alias("a"), F.lit(0).cast("long").alias("b"), F.col("o_orderstatus").alias("c")).alias("nth"), F.col("o_orderstatus").alias("suggested_node"))
    both = lines.union(title).withColumns({"source": F.lit("inclusion"), "text": F.lit("")})
    none = F.lit("")
    no_markers = both.limit(0).select("l_orderkey", "nth", none.alias("reference"), none.alias("biomarker"), none.alias("type"), F.lit(False).alias("in_kb"))
    curated = curate.curate(both, no_markers, "l_orderkey")
    names = vocab.ordered_distinct(both, "l_orderkey", "nth", "suggested_node", "names")
    return curated.join(names, "l_orderkey").select("l_orderkey", F.size("suggestions").cast("long").alias("n_suggestions"), F.array_join("final_suggested_ctml", ",").alias("united"), F.array_join("names", ",").alias("names"))


@query(
    """SELECT o_orderkey, upper(o_orderstatus) AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'Phase II' ELSE 'N/A' END AS phase,
'{"clinical":{"age_numerical":">=' || (o_orderkey % 90) || '"' || CASE WHEN o_orderkey % 2 = 0 THEN ',"gender":"Male"' ELSE '' END || '}}' AS match FROM orders WHERE o_orderkey <= 1000 OR o_orderkey > 0"""
)
def trial_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as public studies in the common trial shape, flattened."""
    key = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    phases = F.when(key % 3 == 0, F.array(F.lit("PHASE2"))).otherwise(F.array(F.lit("NA")))
    studies = table(spark, sf_dir, "orders").select(
        key.cast("string").alias("nct_id"),
        F.col("o_orderpriority").alias("brief_title"),
        none.alias("official_title"),
        F.col("o_orderstatus").alias("overall_status"),
        phases.alias("phases"),
        none.alias("lead_sponsor"),
        none.alias("brief_summary"),
        empty.alias("conditions"),
        F.when(key % 2 == 0, "male").otherwise("all").alias("sex"),
        F.concat(key % 90, F.lit(" Years")).alias("minimum_age"),
        none.alias("maximum_age"),
        empty.alias("std_ages"),
        none.alias("eligibility_criteria"),
        none.alias("principal_investigator"),
        empty.alias("drug_interventions"),
        key.alias("ord"),
    )
    docs = trials.normalize_studies(studies)
    match = F.array_join(F.col("treatment_list.step")[0]["match"], "|")
    return docs.select(F.col("trial_key").cast("long").alias("o_orderkey"), "status", F.col("_summary.phase").alias("phase"), match.alias("match"))


@query(
    """WITH s AS (SELECT n_name AS site, CASE WHEN n_nationkey % 4 = 0 THEN 999999 ELSE n_nationkey + 1 END AS id FROM nation)
SELECT s.site, s.id, p.s_name AS name, 'found' AS state FROM s JOIN supplier p ON s.id = p.s_suppkey UNION ALL SELECT site, id, NULL, 'missing' FROM s WHERE id NOT IN (SELECT s_suppkey FROM supplier)"""
)
def site_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("long")
    sheet = table(spark, sf_dir, "nation").select(F.col("n_name").alias("site_name"), F.when(key % 4 == 0, F.lit(999999).cast("long")).otherwise(key + 1).alias("nct_id"), key.alias("ord"))
    studies = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nct_id"), "s_name", F.col("s_suppkey").alias("ord"))
    found, missing = trials.site_enrich(sheet, studies)
    rows = found.select(F.col("site.site_name").alias("site"), F.col("nct_id").alias("id"), F.col("s_name").alias("name"), F.lit("found").alias("state"))
    return rows.union(missing.select("site_name", "nct_id", F.lit(None).cast("string"), F.lit("missing")))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'a|F;b' WHEN o_orderstatus = 'O' THEN 'a;b' ELSE 'a|{"clinical":{"oncotree_primary_diagnosis":"' || o_orderpriority || '"}};b' END AS steps FROM orders""")
def node_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node for the first of two steps; none for open orders."""
    steps = F.array(F.struct(F.array(F.lit("a")).alias("match")), F.struct(F.array(F.lit("b")).alias("match")))
    node = F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "P", nodes.diagnosis_leaf(F.col("o_orderpriority")))
    out = table(spark, sf_dir, "orders").select("o_orderkey", nodes.append_node(steps, node).alias("s"))
    return out.select("o_orderkey", F.array_join(F.transform("s", lambda x: F.array_join(x["match"], "|")), ";").alias("steps"))


@query(
    """WITH p AS (SELECT p_partkey, p_brand, p_partkey % 5 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN p_brand || ',_SOLID_' WHEN 1 THEN '!' || p_brand ELSE '_LIQUID_,' || p_brand END AS diagnoses FROM p WHERE k < 3"""
)
def diagnosis_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as trials: their name and type are read as diagnoses; of every fifth a null is stored, of others nothing."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("N"), "p_partkey").alias("id"), "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).alias("summary"), "p_brand")
    work = curate.recovery_worklist(parts, "p_partkey", "id", "p_name", "summary")
    k, brand = F.col("p_partkey") % 5, F.col("p_brand")
    names = F.when(k == 0, F.array(brand, F.lit("_SOLID_"), brand)).when(k == 1, F.array(F.concat(F.lit("!"), brand), F.lit("Leukemia"))).when(k == 2, F.array(F.lit("_LIQUID_"), F.lit("qqqqqqqq"), brand))
    store = work.join(parts.select("p_partkey", "p_brand"), "p_partkey").filter(k < 4).select("cache_key", F.to_json(names).alias("value_json"), names.isNull().alias("is_null"), F.lit(0).cast("long").alias("ord"))
    vocabulary = parts.select(F.col("p_brand").alias("name")).distinct()
    found = curate.recovered_diagnoses(work, store, vocabulary, "p_partkey")
    return found.select("p_partkey", F.array_join("diagnoses", ",").alias("diagnoses"))
