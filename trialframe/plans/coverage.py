"""Coverage queries: event types as sources, a user's days as ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import coverage, trials
from .registry import query, table

_IDS = "WITH e AS (SELECT event_type AS source, CASE WHEN event_id % 11 <> 0 THEN user_id::VARCHAR || '-' || strftime(ts, '%Y-%m-%d') END AS id, event_id, ts, value FROM events)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    id = F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.when(F.col("event_id") % 11 != 0, id).alias("id"))


@query(_IDS + "SELECT source, count(*) AS total, count(id) AS with_id, count(*) - count(id) AS without_id FROM e GROUP BY source UNION ALL SELECT 'UNIQUE (all sources)', count(DISTINCT id), count(DISTINCT id), NULL FROM e")
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.source_summary(records(spark, sf_dir), "source", "id")


@query(_IDS + ", d AS (SELECT DISTINCT source, id FROM e WHERE id IS NOT NULL), s AS (SELECT DISTINCT source FROM e) SELECT a.source AS a, b.source AS b, (SELECT count(*) FROM d x JOIN d y ON x.id = y.id WHERE x.source = a.source AND y.source = b.source) AS n FROM s a CROSS JOIN s b")
def overlap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.overlap_matrix(records(spark, sf_dir), "source", "id")


@query(_IDS + ", x AS (SELECT id, min(source) AS source FROM e WHERE id IS NOT NULL GROUP BY id HAVING count(DISTINCT source) = 1) SELECT s.source, count(x.id) AS n FROM (SELECT DISTINCT source FROM e) s LEFT JOIN x ON s.source = x.source GROUP BY s.source")
def exclusive_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.exclusive_ids(records(spark, sf_dir), "source", "id")


@query("SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE o_orderpriority END AS label, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def crosstab_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = clean.defaulted_status(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")))
    return coverage.crosstab(table(spark, sf_dir, "orders"), label, "o_orderstatus", ["F", "O", "P"])


@query("SELECT CASE WHEN p_partkey % 8 = 0 THEN 'Unknown' ELSE p_type END AS label, count(*) FILTER (p_size % 3 = 0) AS \"0\", count(*) FILTER (p_size % 3 = 1) AS \"1\", count(*) FILTER (p_size % 3 = 2) AS \"2\" FROM part GROUP BY 1")
def crosstab_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("source", (F.col("p_size") % 3).cast("string"))
    label = clean.defaulted(F.when(F.col("p_partkey") % 8 != 0, F.col("p_type")).otherwise("  "))
    return coverage.crosstab(parts, label, "source", ["0", "1", "2"])


@query(
    """SELECT source, 'labelled' AS metric, count(l.doc_id) || '/' || count(*) AS share FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source
UNION ALL SELECT source, 'good', count(*) FILTER (quality = 1) || '/' || count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source
UNION ALL SELECT source, 'several lines', count(*) FILTER (contains(text, chr(10))) || '/' || count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source"""
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled")
    joined = docs.join(labels, F.col("doc_id") == F.col("labelled"), "left")
    return coverage.completeness(joined, "source", {"labelled": F.col("labelled").isNotNull(), "good": F.col("quality") == 1, "several lines": F.contains("text", F.lit("\n"))})


@query(
    """WITH e AS (SELECT user_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS sponsor, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS rank, event_id FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank, event_id) AS r FROM e),
c AS (SELECT coalesce(sponsor, 'Unknown') AS sponsor, count(*) AS n, min(rank * 1000000000 + event_id) AS seen FROM p WHERE r = 1 GROUP BY 1)
SELECT sponsor, n FROM c ORDER BY n DESC, seen, sponsor LIMIT 20"""
)
def top_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    events = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("sponsor"), rank.alias("rank"), "event_id")
    return coverage.top_sponsors(events, "user_id", "sponsor", "rank", "event_id")


@query("SELECT md5(text) AS id, count(DISTINCT source) AS n_sources, min(source) AS least, max(source) AS most FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that several sources have: each source's column holds its name or a dash."""
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("id"), "source", F.col("source").alias("value"))
    sources = sorted(r[0] for r in docs.select("source").distinct().collect())  # few
    odd = coverage.conflicts(docs, "id", "source", "value", sources)
    named = F.filter(F.array(*[F.col(f"`{x}`") for x in sources]), lambda v: v != "—")
    return odd.select("id", F.size(named).cast("long").alias("n_sources"), F.array_min(named).alias("least"), F.array_max(named).alias("most"))


@query(
    """WITH u AS (SELECT user_id, count(DISTINCT event_type) AS k FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1),
e AS (SELECT user_id, 's' || (event_id % 3) AS source, event_type FROM events),
f AS (SELECT user_id, source, min(event_type) AS v FROM e GROUP BY 1, 2)
SELECT u.user_id, coalesce(max(v) FILTER (source = 's0'), '—') AS s0, coalesce(max(v) FILTER (source = 's1'), '—') AS s1, coalesce(max(v) FILTER (source = 's2'), '—') AS s2
FROM u JOIN f ON u.user_id = f.user_id GROUP BY u.user_id HAVING count(DISTINCT v) > 1"""
)
def status_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string"))
    events = table(spark, sf_dir, "events").select("user_id", source.alias("source"), "event_type")
    one = events.groupBy("user_id", "source").agg(F.min("event_type").alias("event_type"))
    return coverage.conflicts(one, "user_id", "source", "event_type", ["s0", "s1", "s2"])


@query("SELECT 'priority' AS dim, o_orderpriority AS label FROM orders GROUP BY 2 UNION ALL SELECT 'first' , o_orderkey::VARCHAR FROM (SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10)")
def sorted_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    labels = orders.select(F.lit("priority").alias("dim"), F.col("o_orderpriority").alias("label")).distinct().orderBy("label")
    first = trials.selected(orders.withColumn("ord", F.struct("o_orderdate", "o_orderkey")), limit=10).select(F.lit("first").alias("dim"), F.col("o_orderkey").cast("string").alias("label"))
    return labels.union(first)


@query("SELECT 'customer' AS feed, c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier")
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    def feed(name: str, letter: str) -> DataFrame:
        key = {"c": "c_custkey", "s": "s_suppkey"}[letter]
        return table(spark, sf_dir, name).select(F.lit(name).alias("feed"), F.col(key).alias("key"), F.col(f"{letter}_name").alias("name"), F.col(f"{letter}_nationkey").alias("nation"))

    return trials.united_feeds(feed("customer", "c"), feed("supplier", "s"))


@query(
    """WITH d AS (SELECT source, doc_id, text LIKE '%' || chr(10) || '%' AS lines, len(text) % 3 AS k FROM documents)
SELECT source, 'eligibility' AS metric, count(*) FILTER (lines OR k = 1) || '/' || count(*) AS share FROM d GROUP BY source
UNION ALL SELECT source, 'drugs', count(*) FILTER (k = 2) || '/' || count(*) FROM d GROUP BY source
UNION ALL SELECT source, 'match', count(*) FILTER (doc_id % 4 IN (1, 2, 3)) || '/' || count(*) FROM d GROUP BY source"""
)
def completeness_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags of trials: documents of several lines have inclusion criteria, others exclusion criteria or drugs by length,
    and match trees by id: the age only, another clinical key, a genomic part, or two nodes."""
    k, none = F.length("text") % 3, F.array().cast("array<string>")
    lines = F.split("text", "\n")
    inclusion, exclusion = F.when(F.size(lines) > 1, lines), F.when(k == 1, F.array("source")).otherwise(none)
    drugs = F.when(k == 2, F.array(F.struct(F.col("source").alias("name"))))
    age, gender, gene = (F.lit(x) for x in ('{"clinical":{"age_numerical":">=18"}}', '{"clinical":{"gender":"Male"}}', '{"genomic":{"hugo_symbol":"G"}}'))
    match = F.element_at(F.array(F.array(age), F.array(gender), F.array(gene), F.array(age, gender)), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = table(spark, sf_dir, "documents").select("source", inclusion.alias("inclusion"), exclusion.alias("exclusion"), F.struct(drugs.alias("drugs")).alias("_summary"), F.struct(F.array(F.struct(match.alias("match"))).alias("step")).alias("treatment_list"))
    return coverage.completeness(docs, "source", {"eligibility": coverage.has_eligibility("inclusion", "exclusion"), "drugs": coverage.has_drugs(), "match": coverage.match_beyond_age()})


@query("SELECT user_id, event_type AS source, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_id % 11 <> 0) WHERE r = 1")
def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user the last event of each type; events without a user's id are left out."""
    id = F.when(F.col("event_id") % 11 != 0, F.col("user_id"))
    events = table(spark, sf_dir, "events").select(id.alias("user_id"), F.col("event_type").alias("source"), "event_id", "value", F.struct("ts", "event_id").alias("ord"))
    mapped = coverage.source_map(events, "user_id", "source", "ord")
    return mapped.select("user_id", F.explode("by_source").alias("source", "row")).select("user_id", "source", "row.event_id", "row.value")


@query("SELECT p_partkey, p_name FROM part WHERE p_brand IN ('Brand#11', 'Brand#23')")
def selected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trials of a list of ids; the limit doesn't count then."""
    parts = table(spark, sf_dir, "part").withColumn("ord", F.col("p_partkey"))
    return trials.selected(parts, ids=["Brand#11", "Brand#23"], limit=5, key="p_brand").select("p_partkey", "p_name")


@query(
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '>=18' WHEN 1 THEN '<18' END AS age, CASE p_partkey % 2 WHEN 0 THEN nullif(p_brand, 'Brand#11') END AS protein FROM part"""
)
def age_and_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    age = F.when(key % 3 == 0, "Adults").when(key % 3 == 1, "CHILDREN").otherwise("Both")
    protein = F.when(key % 2 == 1, "na").when(F.col("p_brand") == "Brand#11", "").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", clean.age_predicate(age).alias("age"), clean.na_to_null(protein).alias("protein"))
