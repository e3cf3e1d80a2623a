"""Flow queries: a week's cycle over orders, a coverage report over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import flows, nodes
from .registry import query, table
from .snapshots import _SNAPSHOTS, snapshots

_LEAF = '{"clinical":{"oncotree_primary_diagnosis":"%s"}}'


@query(
    _SNAPSHOTS
    + """, c AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'N') AS n_missing,
  string_agg(CASE l_returnflag WHEN 'A' THEN '{"clinical":{"oncotree_primary_diagnosis":"Accepted"}}' END, ',' ORDER BY l_linenumber, l_partkey, l_shipdate) AS final,
  bool_and(l_quantity <= 45) AS allowed FROM lineitem GROUP BY l_orderkey)
SELECT d.o_orderkey, d.route, CASE d.route WHEN 'unchanged' THEN m_curated WHEN 'deleted' THEN m_curated ELSE n_curated END AS curated,
  CASE WHEN d.route = 'changed' THEN coalesce(c.n, 0) END AS n_suggestions, CASE WHEN d.route = 'changed' THEN coalesce(c.n_missing, 0) END AS n_missing, CASE WHEN d.route = 'changed' THEN coalesce(c.final, '') END AS final,
  CASE WHEN d.route = 'changed' THEN CASE WHEN n_curated = 'F' AND coalesce(c.allowed, true) THEN 'high_confidence' ELSE 'needs_curation' END END AS tier
FROM d LEFT JOIN c ON c.l_orderkey = d.o_orderkey"""
)
def weekly_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trials, their lines as criteria and biomarkers. The store has answers for two return flags, one of them a name that is dropped."""
    new, master = (df.drop("o_totalprice").withColumn("tree", F.when(F.col("curated").startswith("F"), nodes.diagnosis_leaf(F.lit("Breast")))) for df in snapshots(spark, sf_dir))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_partkey", "l_shipdate").alias("nth"), "l_returnflag", "l_quantity")
    criteria = lines.select("o_orderkey", "nth", F.lit("inclusion").alias("source"), F.col("l_returnflag").alias("text"))
    marker = F.when(F.col("l_quantity") > 45, "expression").otherwise("mutation")
    biomarkers = lines.select("o_orderkey", "nth", F.lit("").alias("reference"), F.lit("G").alias("biomarker"), marker.alias("type"), F.lit(True).alias("in_kb"))
    answers = [("A", _LEAF % "Old", 0), ("A", _LEAF % "Accepted", 1), ("R", _LEAF % "Gone", 2)]
    store = spark.createDataFrame(answers, "text string, value_json string, ord long").select(clean.cache_key(F.lit("inclusion"), F.col("text")).alias("cache_key"), "value_json", F.lit(False).alias("is_null"), "ord")
    vocabulary = spark.range(1).select(F.lit("Accepted").alias("name"))
    out = flows.weekly_cycle(new, master, criteria, biomarkers, store, vocabulary, "o_orderkey", F.md5("p"), ["curated"], "tree", ["mutation"], {"Gone": None})
    size = F.when(F.col("route") == "changed", F.coalesce(F.size("curation.suggestions"), F.lit(0)).cast("long"))
    final = F.when(F.col("route") == "changed", F.coalesce(F.array_join("curation.final_suggested_ctml", ","), F.lit("")))
    return out.select("o_orderkey", "route", "curated", size.alias("n_suggestions"), "n_missing", final.alias("final"), "tier")


@query(
    """WITH e AS (SELECT event_type AS source, CASE WHEN event_id % 11 <> 0 THEN user_id END AS id, CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE 's' || (user_id + event_id % 2) % 3 END AS status,
  CASE event_id % 5 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Unknown' ELSE 'p' || event_id % 5 END AS phase, CASE WHEN value > 50 THEN 'Adult' ELSE 'All' END AS age,
  CASE WHEN event_id % 13 = 0 THEN 'Unknown' ELSE 'sponsor' || (user_id * 7 + event_id) % 30 END AS sponsor, event_id, value FROM events),
src AS (SELECT DISTINCT source FROM e), d AS (SELECT DISTINCT source, id FROM e WHERE id IS NOT NULL),
one AS (SELECT id, min(source) AS source FROM d GROUP BY id HAVING count(*) = 1),
sp AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE source {ranks} END, event_id) AS first FROM e WHERE id IS NOT NULL),
top AS (SELECT sponsor, count(*) AS n, min(CASE source {ranks} END * 1000000000000 + event_id) AS seen FROM sp WHERE first = 1 GROUP BY sponsor ORDER BY n DESC, seen, sponsor LIMIT 20),
odd AS (SELECT id FROM e WHERE id IS NOT NULL GROUP BY id HAVING count(DISTINCT status) > 1),
held AS (SELECT id, source, min(status) AS status FROM e WHERE id IS NOT NULL GROUP BY id, source)
SELECT 1 AS section, m AS label, source, CASE m WHEN 'total' THEN n WHEN 'with id' THEN k ELSE n - k END::VARCHAR AS value FROM (SELECT source, count(*) AS n, count(id) AS k FROM e GROUP BY source) CROSS JOIN (VALUES ('total'), ('with id'), ('without id')) AS x(m)
UNION ALL SELECT 1, 'total', 'UNIQUE (all sources)', count(DISTINCT id)::VARCHAR FROM e
UNION ALL SELECT 2, a.source, b.source, (SELECT count(*) FROM d x JOIN d y ON x.id = y.id WHERE x.source = a.source AND y.source = b.source)::VARCHAR FROM src a CROSS JOIN src b
UNION ALL SELECT 3, 'exclusive', src.source, count(one.id)::VARCHAR FROM src LEFT JOIN one ON one.source = src.source GROUP BY src.source
{tabs}
UNION ALL SELECT 7, 'large', source, count(*) FILTER (value > 90) || '/' || count(*) FROM e GROUP BY source
UNION ALL SELECT 7, 'even', source, count(*) FILTER (event_id % 2 = 0) || '/' || count(*) FROM e GROUP BY source
UNION ALL SELECT 8, sponsor, '', n::VARCHAR FROM top
UNION ALL SELECT 9, odd.id::VARCHAR, src.source, coalesce(held.status, '—') FROM odd CROSS JOIN src LEFT JOIN held ON held.id = odd.id AND held.source = src.source""".replace(
        "{ranks}", "WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5"
    )
    .replace("{tabs}", "\n".join(f"UNION ALL SELECT {i}, l.{c}, src.source, (SELECT count(*) FROM e WHERE e.source = src.source AND e.{c} = l.{c})::VARCHAR FROM (SELECT DISTINCT {c} FROM e) l CROSS JOIN src" for i, c in enumerate(("status", "phase", "age"), 4)))
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records: types are sources, users ids; statuses, phases, ages and sponsors come from numbers, some of them blank."""
    id, k = F.col("user_id"), F.col("event_id")
    records = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.when(k % 11 != 0, id).alias("id"),
        F.when(k % 7 != 0, F.concat(F.lit("s"), (id + k % 2) % 3)).alias("status"),
        F.when(k % 5 == 1, "  ").when(k % 5 > 1, F.concat(F.lit("p"), k % 5)).alias("phase"),
        F.when(F.col("value") > 50, "Adult").otherwise("All").alias("age"),
        F.when(k % 13 != 0, F.concat(F.lit("sponsor"), (id * 7 + k) % 30)).alias("sponsor"),
        k.alias("ord"),
        "value",
    )
    return flows.coverage_report(records, {"large": F.col("value") > 90, "even": F.col("ord") % 2 == 0}, sorted(r[0] for r in records.select("source").distinct().collect()))
