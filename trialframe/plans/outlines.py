"""Outline queries: the lines of documents as outline items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import outline
from .registry import query, table

# headers are lines whose length divides by 5, in turn inclusion and exclusion; depth is the length modulo 4
_LINES = """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(a))) AS pos, unnest(a) AS line FROM s),
h AS (SELECT *, len(line) % 5 = 0 AS is_header, len(line) % 4 AS depth, sum(CASE WHEN len(line) % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM l),
i AS (SELECT doc_id, pos, line, depth, run, CASE WHEN run % 2 = 1 THEN 'inclusion' ELSE 'exclusion' END AS source FROM h WHERE NOT is_header AND run > 0 AND line <> ''),
c AS (SELECT i.*, CASE WHEN depth >= 2 THEN (SELECT max(q.pos) FROM i q WHERE q.doc_id = i.doc_id AND q.run = i.run AND q.depth = i.depth - 1 AND q.pos < i.pos) END AS parent_pos FROM i)
"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    number = F.count(F.when(F.length("line") % 5 == 0, 1)).over(Window.partitionBy("doc_id").orderBy("pos"))
    return lines.withColumn("header", F.when(F.length("line") % 5 == 0, F.when(number % 2 == 1, "inclusion").otherwise("exclusion")))


def criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    return outline.parse_outline(lines, "doc_id", "pos", F.col("header"), F.length("line") % 4, F.col("line"))


@query(_LINES + "SELECT doc_id, source, run::INTEGER AS run, pos::INTEGER AS pos, depth::INTEGER AS depth, parent_pos::INTEGER AS parent_pos, md5(line) AS text FROM c")
def outline_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return criteria(spark, sf_dir).withColumn("text", F.md5("text"))


@query(
    _LINES.replace("WITH s", "WITH RECURSIVE s")
    + """, t(doc_id, pos, root, level, path, line, source) AS (
  SELECT doc_id, pos, pos, 0, [pos], line, source FROM c WHERE parent_pos IS NULL
  UNION ALL SELECT c.doc_id, c.pos, t.root, t.level + 1, list_append(t.path, c.pos), c.line, c.source FROM c JOIN t ON c.doc_id = t.doc_id AND c.parent_pos = t.pos)
SELECT doc_id, source, root::INTEGER AS root_pos, md5(string_agg(repeat('  ', level) || line, chr(10) ORDER BY path)) AS text FROM t GROUP BY doc_id, source, root"""
)
def outline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = outline.criteria_worklist(criteria(spark, sf_dir), "doc_id")
    return work.select("doc_id", "source", "root_pos", F.md5("text").alias("text"))


@query(
    """WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(a))) AS pos, unnest(a) AS line FROM s),
m AS (SELECT doc_id, pos + 1 AS pos, len(line) % 3 AS level, trim(regexp_replace(line, '^[*]+\\s*', '')) AS body FROM l WHERE trim(regexp_replace(line, '^[*]+\\s*', '')) <> ''),
c AS (SELECT m.*, CASE WHEN level >= 1 THEN (SELECT max(q.pos) FROM m q WHERE q.doc_id = m.doc_id AND q.level = m.level - 1 AND q.pos < m.pos) END AS parent_pos FROM m)
SELECT doc_id, pos::INTEGER AS pos, (level + 1)::INTEGER AS depth, parent_pos::INTEGER AS parent_pos FROM c"""
)
def outline_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bulleted = F.transform(F.split("text", "\n"), lambda x: F.concat(F.repeat(F.lit("  "), F.length(x) % 3), F.lit("* "), x))
    text = F.concat(F.lit("Inclusion Criteria:\n"), F.array_join(bulleted, "\n"))
    found = outline.parse_outline_markdown(docs.select("doc_id", text.alias("text")), "doc_id", "text")
    return found.select("doc_id", "pos", "depth", "parent_pos")


@query(
    _LINES.replace("WITH s", "WITH RECURSIVE s")
    + """, t(doc_id, pos, root, level, path, line, source) AS (
  SELECT doc_id, pos, pos, 0, [pos], line, source FROM c WHERE parent_pos IS NULL
  UNION ALL SELECT c.doc_id, c.pos, t.root, t.level + 1, list_append(t.path, c.pos), c.line, c.source FROM c JOIN t ON c.doc_id = t.doc_id AND c.parent_pos = t.pos)
SELECT doc_id, md5(string_agg(repeat('  ', level) || line, chr(10) ORDER BY CASE source WHEN 'inclusion' THEN 0 ELSE 1 END, root, path)) AS text FROM t GROUP BY doc_id"""
)
def outline_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = outline.criteria_worklist(criteria(spark, sf_dir), "doc_id")
    return outline.full_text(work, "doc_id").select("doc_id", F.md5("text").alias("text"))


@query(
    """WITH s AS (SELECT doc_id, string_split(replace(text, '|', '/'), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(a))) AS pos, unnest(a) AS line FROM s),
h AS (SELECT *, len(line) % 5 = 0 AS is_header, len(line) % 4 AS depth, sum(CASE WHEN len(line) % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run,
  last_value(CASE WHEN len(line) % 5 = 0 THEN pos % 2 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS kind FROM l),
i AS (SELECT * FROM h WHERE NOT is_header AND run > 0 AND trim(line) <> ''),
c AS (SELECT i.*, CASE WHEN depth >= 2 THEN (SELECT max(q.pos) FROM i q WHERE q.doc_id = i.doc_id AND q.run = i.run AND q.depth = i.depth - 1 AND q.pos < i.pos) END AS parent_pos FROM i)
SELECT doc_id, CASE kind WHEN 0 THEN 'inclusion' ELSE 'exclusion' END AS source, pos::INTEGER AS pos, depth::INTEGER AS depth, parent_pos::INTEGER AS parent_pos, md5(trim(line)) AS text FROM c"""
)
def outline_tilde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tilde outlines: lines whose length divides by 5 are headers, others have
    their length modulo 4 as depth; the separator of outlines is written as a slash."""
    header = lambda i: F.when(i % 2 == 0, "Inclusion Criteria:").otherwise(" exclusion criteria ")
    items = F.transform(F.split(F.replace(F.col("text"), F.lit("|"), F.lit("/")), "\n"), lambda x, i: F.when(F.length(x) % 5 == 0, header(i)).otherwise(F.concat(F.repeat(F.lit("~"), (F.length(x) % 4).cast("int")), x)))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(items, "||").alias("text"))
    return outline.parse_outline_tilde(docs, "doc_id", "text").select("doc_id", "source", "pos", "depth", "parent_pos", F.md5("text").alias("text"))
