"""Eligibility outlines as flat criteria tables that keep their nesting.

Criteria: (key, source, run, pos, depth, parent_pos, text). ``run`` numbers the stretches between section
headers; ``parent_pos`` is null at the top level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import strip
from ..sources.shared import stored


def parse_outline(lines: DataFrame, key: str, pos: str, header: Column, depth: Column, text: Column) -> DataFrame:
    """Criteria of the lines of each ``key``.

    ``header`` is a section's name on its header line and null elsewhere; lines before the first header and
    lines without text are dropped. An item's parent is the latest item one level higher in the same
    run; items of depth 0 or 1, and those without such a one, are at the top.
    """
    doc = Window.partitionBy(key).orderBy(pos)
    rows = lines.select(key, F.col(pos).alias("pos"), header.alias("__header"), depth.cast("int").alias("depth"), text.alias("text"))
    rows = rows.withColumn("run", F.count("__header").over(doc).cast("int")).withColumn("source", F.last("__header", ignorenulls=True).over(doc))
    items = rows.filter(F.col("__header").isNull() & (F.col("run") > 0) & F.col("text").isNotNull() & (F.col("text") != ""))
    # each item once as a possible parent (at its own level) and once as a child (at the level above):
    # the latest parent before the child is the last one seen. The text stays out of it.
    roles = items.select(key, "run", "pos", "depth", F.explode(F.array(F.lit(True), F.lit(False))).alias("__parent"))
    roles = roles.withColumn("__level", F.when(F.col("__parent"), F.col("depth")).otherwise(F.col("depth") - 1))
    level = Window.partitionBy(key, "run", "__level").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(F.col("__parent"), F.col("pos")), ignorenulls=True).over(level)
    parents = roles.withColumn("__seen", seen).filter(~F.col("__parent")).select(key, "pos", F.when(F.col("depth") >= 2, F.col("__seen")).alias("parent_pos"))
    return items.join(parents, [key, "pos"]).select(key, "source", "run", "pos", "depth", "parent_pos", "text")


def section_header(line: Column, whole: bool) -> Column:
    """``inclusion`` or ``exclusion`` of a header line; ``whole``: nothing may follow on the line."""
    low = F.lower(strip(line))
    end = r"\s*$" if whole else ""
    return F.when(low.rlike(rf"^inclusion criteria\s*:?{end}"), "inclusion").when(low.rlike(rf"^exclusion criteria\s*:?{end}"), "exclusion")


def parse_outline_tilde(df: DataFrame, key: str, text: str) -> DataFrame:
    """Outline with ``||`` between items and their depth as leading ``~``."""
    lines = df.select(key, F.posexplode(F.split(text, r"\|\|")).alias("pos", "line")).withColumn("line", strip("line"))
    body = F.regexp_replace(strip(F.regexp_replace("line", "^~+", "")), r"^(?i)(inclusion|exclusion) criteria\s*:\s*", "")
    depth = F.length("line") - F.length(F.regexp_replace("line", "^~+", ""))
    return parse_outline(lines, key, "pos", section_header(F.col("line"), whole=True), depth, body)


def parse_outline_markdown(df: DataFrame, key: str, text: str) -> DataFrame:
    """Outline as lines with ``*`` and two blanks of indent for each level; a header line's further text is lost."""
    lines = df.select(key, F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("pos", "line"))
    indent = F.length("line") - F.length(F.regexp_replace("line", r"^\s+", ""))
    body = strip(F.regexp_replace(strip("line"), r"^\*+\s*", ""))
    return parse_outline(lines, key, "pos", section_header(F.col("line"), whole=False), F.greatest(F.lit(1), F.floor(indent / 2) + 1), body)


def criterion_paths(criteria: DataFrame, key: str) -> DataFrame:
    """Criteria with ``path``, the positions from the top item down to the item itself, and ``root_pos``, at any depth.

    Each item starts with the link to its parent; in every round the stretches of path that meet are joined and the links become twice as
    long, so the number of rounds is the logarithm of the depth (one for outlines of two levels). A document may span tasks. Rounds are stored in the shared
    folder, without texts. A parent that isn't there, or doesn't come before its item, counts as none; of several items at one position the first parent counts.
    """
    before = F.when(F.col("parent_pos") < F.col("pos"), F.col("parent_pos"))
    links = criteria.groupBy(F.col(key).alias("__key"), F.col("pos").alias("__at")).agg(F.min(before).alias("__up"))
    paths = stored(links.withColumn("path", F.array(F.col("__at").cast("int"))), "paths")
    while not paths.filter("__up IS NOT NULL").isEmpty():
        low, high = paths.alias("low"), paths.alias("high")
        joined = low.join(high, F.col("low.__key").eqNullSafe(F.col("high.__key")) & (F.col("low.__up") == F.col("high.__at")), "left")
        longer = F.concat(F.coalesce("high.path", F.array().cast("array<int>")), "low.path")
        paths = stored(joined.select("low.__key", "low.__at", F.col("high.__up").alias("__up"), longer.alias("path")), "paths")
    own = criteria.drop("path", "root_pos")
    found = own.join(paths.drop("__up"), F.col(key).eqNullSafe(F.col("__key")) & (F.col("pos") == F.col("__at"))).drop("__key", "__at")
    return found.withColumn("root_pos", F.element_at("path", 1))


def criteria_worklist(criteria: DataFrame, key: str) -> DataFrame:
    """(key, source, root_pos, text): each top-level criterion with its sub-criteria, indented two blanks a level.

    ``nth`` is its place in its document, inclusion before exclusion.
    """
    lines = criterion_paths(criteria, key)
    line = F.concat(F.repeat(F.lit("  "), F.size("path") - 1), "text")
    whole = F.array_sort(F.collect_list(F.struct("path", line.alias("line"))))
    tops = lines.groupBy(key, "source", "root_pos").agg(F.array_join(F.transform(whole, lambda x: x["line"]), "\n").alias("text"))
    order = Window.partitionBy(key).orderBy(F.when(F.col("source") == "inclusion", 0).otherwise(1), "root_pos")
    return tops.withColumn("nth", F.row_number().over(order))


def full_text(worklist: DataFrame, key: str) -> DataFrame:
    """(key, text): all criteria of a document, a line break between them."""
    rows = F.array_sort(F.collect_list(F.struct("nth", "text")))
    return worklist.groupBy(key).agg(F.array_join(F.transform(rows, lambda x: x["text"]), "\n").alias("text"))
