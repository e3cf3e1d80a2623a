"""Cleaning queries: the driver's text columns, bent into the shapes that the functions expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, rules
from .registry import query, table


@query("SELECT c_custkey, TRY_CAST(nullif(regexp_extract(c_name, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE) AS number FROM customer")
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", clean.parse_first_number(F.col("c_name")).alias("number"))


@query(
    """WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN replace(p_name, ' ', '::') WHEN 1 THEN replace(p_name, ' ', '/') WHEN 2 THEN replace(p_name, ' ', ' - ') ELSE 'x' END AS g FROM part),
s AS (SELECT *, CASE WHEN contains(g, '::') THEN '::' WHEN contains(g, '/') THEN '/' WHEN contains(g, '-') THEN '-' END AS sep FROM p)
SELECT p_partkey, CASE WHEN sep IS NULL THEN g ELSE trim(substr(g, 1, instr(g, sep) - 1)) END AS "left", CASE WHEN sep IS NOT NULL THEN trim(substr(g, instr(g, sep) + len(sep))) END AS "right" FROM s"""
)
def split_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    k, name = F.col("p_partkey") % 4, F.col("p_name")
    gene = F.when(k == 0, F.replace(name, F.lit(" "), F.lit("::"))).when(k == 1, F.replace(name, F.lit(" "), F.lit("/"))).when(k == 2, F.replace(name, F.lit(" "), F.lit(" - "))).otherwise("x")
    return parts.select("p_partkey", gene.alias("g")).select("p_partkey", clean.split_pair(F.col("g")).alias("p")).select("p_partkey", "p.left", "p.right")


@query(
    """SELECT s_suppkey, CASE WHEN regexp_matches(id, '^NCT[0-9]{8}$') THEN id END AS id FROM (SELECT s_suppkey, upper(regexp_replace(
CASE s_suppkey % 3 WHEN 0 THEN ' nct ' || lpad(s_suppkey::VARCHAR, 8, '0') || chr(9) WHEN 1 THEN 'NCT' || s_suppkey ELSE s_name END, '\\s+', '', 'g')) AS id FROM supplier)"""
)
def clean_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    raw = F.when(key % 3 == 0, F.concat(F.lit(" nct "), F.lpad(key.cast("string"), 8, "0"), F.lit("\t"))).when(key % 3 == 1, F.concat(F.lit("NCT"), key)).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", clean.clean_registry_id(raw).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate::DATE END AS date FROM orders")
def coerce_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, date = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(date, "yyyy-M-d")).when(k == 1, F.date_format(date, "dd-MMM-yy")).when(k == 2, F.date_format(date, "MM/dd/yyyy")).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", clean.coerce_date(text).alias("date"))


@query("SELECT p_partkey, array_to_string(list_filter([p_brand, trim(p_type), p_name], lambda x: x <> ''), '|') AS items FROM part")
def split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "p_brand", F.lit(" ;; "), "p_type", F.lit("\t;  ;"), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(clean.split_list(raw, ";"), "|").alias("items"))


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open to accrual' WHEN 'F' THEN 'closed to accrual' ELSE o_orderstatus END AS status,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'N/A' WHEN o_orderpriority = '2-HIGH' THEN 'phase 2' ELSE 'Phase ' || o_orderpriority END AS phase,
CASE o_orderkey % 4 WHEN 0 THEN 'Adult' WHEN 1 THEN 'Pediatric' WHEN 2 THEN 'Both' ELSE 'teens' END AS age,
CASE o_orderkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'All' ELSE 'x' END AS trial_gender,
CASE o_orderkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN NULL ELSE 'Female' END AS patient_gender,
CASE o_orderkey % 3 WHEN 0 THEN '>=' || (o_orderkey % 50) END AS min_age FROM orders"""
)
def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pick(n: int, *values: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("o_orderkey") % n + 1).cast("int"))

    status = F.when(F.col("o_orderstatus") == "O", " open to accrual").when(F.col("o_orderstatus") == "F", "Completed").otherwise(F.col("o_orderstatus"))
    phase = F.when(F.col("o_orderpriority") == "1-URGENT", "N/A").when(F.col("o_orderpriority") == "2-HIGH", "phase 2").otherwise(F.col("o_orderpriority"))
    age = F.concat(F.col("o_orderkey") % 50, pick(3, " Years", " Months", " days"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        clean.map_code(status, rules.REGISTRY_STATUS).alias("status"),
        clean.phase_label(phase).alias("phase"),
        clean.age_group(pick(4, "Adults", "children", "Unspecified", "teens")).alias("age"),
        clean.trial_gender(pick(3, "male", "ALL", "x")).alias("trial_gender"),
        clean.patient_gender(pick(3, " M", "other", "FEMALE")).alias("patient_gender"),
        clean.min_age_predicate(age).alias("min_age"),
    )


@query(
    """WITH p AS (SELECT p_partkey, p_partkey % 6 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN 'Phase I' WHEN 1 THEN 'Phase I/II' WHEN 2 THEN 'Phase I/I' WHEN 3 THEN 'N/A' WHEN 4 THEN 'PHASE9' END AS phase,
CASE k WHEN 0 THEN 'Adult' WHEN 1 THEN 'Both' WHEN 2 THEN 'Pediatric' WHEN 3 THEN 'Both' WHEN 4 THEN 'Adult' END AS age FROM p"""
)
def phase_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = ["PHASE1"], ["PHASE2", "PHASE1"], ["PHASE1", "EARLY_PHASE1"], ["NA"], ["PHASE9"], []
    ages = ["ADULT"], ["CHILD", "ADULT"], ["CHILD"], ["CHILD", "OLDER_ADULT"], ["OLDER_ADULT", "ADULT"], []

    def pick(lists: tuple[list[str], ...]) -> Column:
        typed = [F.array(*map(F.lit, x)).cast("array<string>") for x in lists]
        return F.element_at(F.array(*typed), (F.col("p_partkey") % 6 + 1).cast("int"))

    return table(spark, sf_dir, "part").select("p_partkey", clean.phase_set_label(pick(phases)).alias("phase"), clean.age_group_set(pick(ages)).alias("age"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, key, value FROM (
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'raw_flag' AS key, nullif(l_returnflag, 'N') AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'raw_status', nullif(l_linestatus, 'O') FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'raw_line', CASE WHEN l_linenumber > 2 THEN l_linenumber::VARCHAR END FROM lineitem) WHERE value IS NOT NULL"""
)
def raw_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    flag, status = (F.nullif(F.col(c), F.lit(v)) for c, v in (("l_returnflag", "N"), ("l_linestatus", "O")))
    line = F.when(F.col("l_linenumber") > 2, F.col("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select(*keys, flag.alias("raw_flag"), status.alias("raw_status"), line.alias("raw_line"))
    return clean.collect_raw_map(rows).select(*keys, F.explode("raw").alias("key", "value"))


@query(
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'x' ELSE json_extract_string(props, '$.k') END AS k FROM events)
SELECT CASE WHEN k IS NULL OR k = '' THEN 'k missing' WHEN TRY_CAST(k AS BIGINT) IS NULL THEN 'k not long' ELSE 'good' END AS reason, count(*) AS n FROM e GROUP BY 1"""
)
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.when(F.col("event_id") % 97 == 0, None).when(F.col("event_id") % 89 == 0, "x").otherwise(F.get_json_object("props", "$.k"))
    good, bad = clean.validate(table(spark, sf_dir, "events").select("event_id", k.alias("k")), {"k": "long"})
    counts = bad.select(F.explode("reason").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    return counts.union(good.agg(F.lit("good").alias("reason"), F.count("*").alias("n")))


@query(
    """WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN 0 ELSE 2 END AS n, p_name, p_brand FROM part)
SELECT p_partkey, n AS n_items, CASE WHEN n = 2 THEN p_name || '|' || p_brand ELSE '' END AS items FROM p"""
)
def answer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.to_json(F.array("p_name", "p_brand"))
    k = F.col("p_partkey") % 4
    answer = F.when(k == 0, items).when(k == 1, F.concat(F.lit("```json\n"), items, F.lit("\n```"))).when(k == 2, F.concat(F.lit("  ```\njson "), items, F.lit("```"))).otherwise(F.concat(F.lit('{"a": '), items))
    parsed = table(spark, sf_dir, "part").select("p_partkey", clean.parse_json_array(answer).alias("x"))
    return parsed.select("p_partkey", F.size("x").alias("n_items"), F.array_join("x", "|").alias("items"))


@query(
    """SELECT o_orderkey, json_extract_string(j, '$.a.id') AS id, json_extract_string(j, '$.a.title') AS title, CASE WHEN o_orderstatus = 'F' THEN 'D' || o_orderkey ELSE '' END AS drugs,
CASE WHEN o_orderkey % 2 = 0 THEN 'P' || o_custkey END AS investigator FROM (SELECT *, '{"a": {"id": "' || o_orderkey || '", "title": "' || o_orderpriority || '"}}' AS j FROM orders)"""
)
def study_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .. import schemas
    from ..operators import trials

    official = F.struct(F.when(F.col("o_orderkey") % 2 == 0, "PRINCIPAL_INVESTIGATOR").otherwise("CHAIR").alias("role"), F.concat(F.lit("P"), "o_custkey").alias("name"))
    drug = F.struct(F.when(F.col("o_orderstatus") == "F", "DRUG").otherwise("DEVICE").alias("type"), F.concat(F.lit("D"), "o_orderkey").alias("name"))
    ident = F.struct(F.col("o_orderkey").cast("string").alias("nctId"), F.col("o_orderpriority").alias("briefTitle"))
    study = F.struct(ident.alias("identificationModule"), F.struct(F.array(drug).alias("interventions")).alias("armsInterventionsModule"), F.struct(F.array(official).alias("overallOfficials")).alias("contactsLocationsModule"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.from_json(F.to_json(study), f"array<{schemas.PROTOCOL_SECTION}>".replace("array<", "", 1)[:-1]).alias("s"))
    flat = rows.select("o_orderkey", *trials.project_study(F.col("s")))
    return flat.select("o_orderkey", F.col("nct_id").alias("id"), F.col("brief_title").alias("title"), F.array_join("drug_interventions", "|").alias("drugs"), F.col("principal_investigator").alias("investigator"))


@query(
    """WITH r(c1, c2, c3, v) AS (VALUES ('Brand#11', 'STANDARD', '1', 'exact'), ('Brand#11', 'STANDARD', '', 'pair'), ('Brand#11', '', '', 'brand'), ('Brand#12', 'SMALL', '', NULL), ('Brand#12', '', '', 'twelve'), ('Brand#13', '', '', NULL)),
p AS (SELECT p_partkey, p_brand AS a, p_type AS b, (p_size % 3)::VARCHAR AS c FROM part)
SELECT p_partkey, CASE WHEN x.c1 IS NOT NULL THEN x.v WHEN y.c1 IS NOT NULL THEN y.v WHEN z.c1 IS NOT NULL THEN z.v END AS value FROM p
LEFT JOIN r x ON x.c1 = a AND x.c2 = b AND x.c3 = c LEFT JOIN r y ON y.c1 = a AND y.c2 = b AND y.c3 = '' LEFT JOIN r z ON z.c1 = a AND z.c2 = '' AND z.c3 = ''"""
)
def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import vocab

    table_rules = {
        ("Brand#11", "STANDARD", "1"): "exact",
        ("Brand#11", "STANDARD", ""): "pair",
        ("Brand#11", "", ""): "brand",
        ("Brand#12", "SMALL", ""): None,
        ("Brand#12", "", ""): "twelve",
        ("Brand#13", "", ""): None,
    }
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("a"), F.col("p_type").alias("b"), (F.col("p_size") % 3).cast("string").alias("c"))
    return vocab.rule_cascade(parts, vocab.cascade_table(spark, table_rules), "a", "b", "c").select("p_partkey", "value")


_KEYWORDS = [("the ", "the"), ("tion", None), ("und", "und"), ("de ", "de"), ("ion", "ion")]


@query("SELECT doc_id, " + "CASE" + "".join(f" WHEN contains(lower(text), '{k}') THEN " + (f"'{v}'" if v else "NULL") for k, v in _KEYWORDS) + " END AS value FROM documents")
def keyword_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean.first_keyword(F.col("text"), _KEYWORDS).alias("value"))


@query(
    """WITH r AS (SELECT lower(n_name) AS keyword, n_nationkey AS pos, CASE WHEN n_nationkey % 4 > 0 THEN n_name END AS value FROM nation
UNION ALL SELECT word, 1000 + item_id * 1000 + length(word), word FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS word FROM benchmark) WHERE length(word) >= 5),
hit AS (SELECT doc_id, arg_min({'value': value}, {'pos': pos, 'value': coalesce(value, '')}) AS v FROM documents JOIN r ON contains(lower(text), keyword) GROUP BY doc_id)
SELECT doc_id, v.value AS value FROM documents LEFT JOIN hit USING (doc_id)"""
)
def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations and then the words of the benchmark as rules over the documents."""
    from ..operators import vocab

    key = F.col("n_nationkey").cast("long")
    nations = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("keyword"), key.alias("pos"), F.when(key % 4 > 0, F.col("n_name")).alias("value"))
    words = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split(F.lower("text"), " ")).alias("keyword")).filter(F.length("keyword") >= 5)
    rules = nations.unionByName(words.select("keyword", (1000 + F.col("item_id") * 1000 + F.length("keyword")).alias("pos"), F.col("keyword").alias("value")))
    return vocab.keyword_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", rules).select("doc_id", "value")


@query(
    """WITH v AS (SELECT DISTINCT p_name AS name FROM part), n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '!' || p_name WHEN 1 THEN 'Old Name' WHEN 2 THEN 'Gone Name' WHEN 3 THEN 'zzzzzzzzzzzz' ELSE p_name END AS name FROM part)
SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN (SELECT min(name) FROM v) WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE name END AS resolved FROM n"""
)
def vocab_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import vocab

    parts = table(spark, sf_dir, "part")
    vocabulary = parts.select(F.col("p_name").alias("name")).distinct()
    first = vocabulary.agg(F.min("name")).head()[0]
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, F.concat(F.lit("!"), "p_name")).when(k == 1, "Old Name").when(k == 2, "Gone Name").when(k == 3, "zzzzzzzzzzzz").otherwise(F.col("p_name"))
    names = parts.select("p_partkey", name.alias("name"))
    return vocab.resolve(names, vocabulary, corrections={"Old Name": first, "Gone Name": None}).select("p_partkey", "resolved")


#: the ratio of Ratcliff and Obershelp in SQL: the longest common block (the first in the vocabulary's name, then in the other), then what is left and right of it
_RATIO = """WITH RECURSIVE v AS (SELECT DISTINCT p_name AS a FROM part), n AS (SELECT DISTINCT p_name[1:3] || 'q' || p_name[5:] AS b FROM part),
pairs AS (SELECT a, b FROM v, n WHERE a <> b AND b NOT IN (SELECT a FROM v) AND 2 * least(len(a), len(b)) >= 0.85 * (len(a) + len(b))),
parts AS (
  SELECT a, b, 0 AS i, len(a) AS x, 0 AS j, len(b) AS y, 0 AS k, 0 AS p, 0 AS q FROM pairs
  UNION ALL
  SELECT a, b, i, x, j, y, best.k, -best.p AS p, -best.q AS q FROM (
    SELECT *, list_max(list_transform(flatten(list_transform(range(i, x), lambda p: list_transform(range(j, y), lambda q: [p, q]))),
      lambda c: {'k': coalesce(list_max(list_filter(range(1, least(x - c[1], y - c[2]) + 1), lambda k: a[c[1] + 1 : c[1] + k] = b[c[2] + 1 : c[2] + k])), 0), 'p': -c[1], 'q': -c[2]})) AS best
    FROM (SELECT a, b, unnest(CASE WHEN k = 0 THEN [[i, x, j, y]] ELSE [[i, p, j, q], [p + k, x, q + k, y]] END) AS r, r[1] AS i, r[2] AS x, r[3] AS j, r[4] AS y FROM parts)
    WHERE i < x AND j < y)
  WHERE best.k > 0
), scored AS (SELECT a, b, 2.0 * sum(k) / (len(a) + len(b)) AS ratio FROM parts GROUP BY a, b),
close AS (SELECT b, arg_max(a, {'r': ratio, 'a': a}) AS a FROM scored WHERE ratio >= 0.85 GROUP BY b)
SELECT p_partkey, p_name[1:3] || 'q' || p_name[5:] AS name, coalesce(v.a, close.a) AS resolved FROM part LEFT JOIN v ON v.a = p_name[1:3] || 'q' || p_name[5:] LEFT JOIN close ON close.b = p_name[1:3] || 'q' || p_name[5:]"""


@query(_RATIO)
def vocab_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with one letter changed, resolved by likeness."""
    from ..operators import vocab

    parts = table(spark, sf_dir, "part")
    typo = F.concat(F.substring("p_name", 1, 3), F.lit("q"), F.expr("substring(p_name, 5)"))
    return vocab.resolve(parts.select("p_partkey", typo.alias("name")), parts.select(F.col("p_name").alias("name")), corrections={})
