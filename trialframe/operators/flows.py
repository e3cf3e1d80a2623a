"""Whole flows from the operators: the weekly cycle of a master of trials, and the report on coverage.

Both are lazy plans, but for what they use several times and store once in the shared folder: names, validated suggestions and grouped rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..sources.shared import stored
from . import annotate, curate, lifecycle, nodes


def suggested_nodes(work: DataFrame, store: DataFrame, vocabulary: DataFrame, corrections: dict[str, str | None] | None = None) -> DataFrame:
    """``work`` (with ``cache_key``) with ``hit`` and ``suggested_node``: the stored answer with its diagnosis names resolved, null where there
    is none or nothing of it is left. Every distinct answer is validated once."""
    found = annotate.look_up(work, store)
    answers = found.filter("value_json IS NOT NULL").select("cache_key", "value_json").distinct()
    valid = nodes.validate_nodes(answers, vocabulary, "cache_key", "value_json", corrections)
    return found.drop("value_json").join(valid.withColumnRenamed("node", "suggested_node"), "cache_key", "left")


def weekly_cycle(
    new: DataFrame,
    master: DataFrame,
    criteria: DataFrame,
    biomarkers: DataFrame,
    store: DataFrame,
    vocabulary: DataFrame,
    key: str,
    compared: Column,
    carried: list[str],
    tree: str,
    allowed: list[str],
    corrections: dict[str, str | None] | None = None,
) -> DataFrame:
    """The new master, deleted trials included: diff, curation of what changed, confidence tiers, merge.

    ``new`` and ``master`` are snapshots with equal columns; ``criteria`` (key, nth, source, text) and ``biomarkers`` (key, nth, reference, biomarker,
    type, in_kb) are those of the new one; ``tree`` names the trial's match tree. Rows have ``new``'s columns and route (unchanged, changed or deleted), and, where they
    changed, curation (suggestions, biomarker_references, final_suggested_ctml), n_missing (criteria without a stored answer: ``annotate.misses`` lists them) and tier
    (high_confidence or needs_curation). Trials without a key have a route of their own, ``rejected``. A repeated key of ``new`` gives repeated rows.
    """
    keyed, keyless = lifecycle.split_keyless(new, key)
    routed = lifecycle.route_snapshot(keyed, lifecycle.split_keyless(master, key)[0], key, compared, carried)
    changed = routed.filter("route = 'changed'").select(key).distinct()
    work = criteria.join(changed, key, "left_semi").withColumn("cache_key", clean.cache_key(F.col("source"), F.col("text")))
    suggested = stored(suggested_nodes(work, store, vocabulary, corrections), "suggested")  # used twice, and its plan is long
    curated = curate.curate(suggested, biomarkers.join(changed, key, "left_semi"), key)
    missing = suggested.groupBy(key).agg(F.count_if(~F.col("hit")).alias("n_missing"))
    trees = routed.filter(f"route = 'changed' AND {tree} IS NOT NULL").select(tree).distinct()
    sure = stored(nodes.has_diagnosis(nodes.flatten_nodes(trees, tree, tree), tree), "diagnoses")
    kept = [c for c in curated.columns if c != key]
    rows = routed.filter("route = 'changed'").join(curated, key, "left").join(missing, key, "left").join(sure, tree, "left")
    tiered = curate.split_by_confidence(rows, F.col("has_diagnosis"), F.transform("biomarker_references", lambda b: b["type"]), allowed)
    tiered = tiered.select(*new.columns, "route", F.struct(*kept).alias("curation"), F.coalesce("n_missing", F.lit(0).cast("long")).alias("n_missing"), "tier")
    other = routed.filter("route <> 'changed'").unionByName(keyless.withColumn("route", F.lit("rejected")))
    return other.unionByName(tiered, allowMissingColumns=True)


SECTIONS = ("summary", "overlap", "exclusive ids", "status", "phase", "age", "completeness", "top sponsors", "status conflicts")
UNIQUE = "UNIQUE (all sources)"


def coverage_report(records: DataFrame, flags: dict[str, Column], sources: list[str], limit: int = 20, missing: str = "—") -> DataFrame:
    """(section, label, source, value): the nine sections of ``SECTIONS`` over all records, numbered from 1.

    ``records``: source, id, status, phase, age, sponsor and ord (the order in which sponsors were seen); ``flags`` are conditions on its columns;
    ``sources`` are the sources in their order. The records are read once: GROUPING SETS count them by source, by each dimension and source, and by id, and all
    sections come from these groups. Cross-tabs and the overlap have a row for each label and source, zeros included. Conflicts have a row for each source of an id; a source
    with several statuses has the least. Records without an id count where no id is needed; blank dimensions are ``Unknown`` (status: unknown).
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    dims = {"status": clean.defaulted_status(F.col("status")), "phase": clean.defaulted(F.col("phase")), "age": clean.defaulted(F.col("age"))}
    sponsor = clean.strip(F.coalesce(clean.filled(F.col("sponsor")), F.lit("Unknown")))
    rows = records.select("source", "id", *[c.alias(n) for n, c in dims.items()], F.when(sponsor != "", sponsor).alias("sponsor"), F.struct(rank.alias("rank"), "ord").alias("seen"), *[c.alias(f"flag{i}") for i, c in enumerate(flags.values())])
    sets = [["source"], *[["source", d] for d in dims], ["id"]]
    named = F.when(F.col("sponsor").isNotNull(), F.col("seen"))
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], "source", "id", *dims).agg(
        F.grouping_id().alias("g"),
        F.count("*").alias("total"),
        F.count("id").alias("with_id"),
        *[F.count_if(f"flag{i}").alias(f"flag{i}") for i in range(len(flags))],
        F.collect_set(F.struct("source", "status")).alias("held"),
        F.min_by("sponsor", named).alias("sponsor"),
        F.min(named).alias("seen"),
    )
    grouped = stored(grouped, "groups")
    bits = ("source", "id", *dims)
    # the bit of a column that isn't part of the set is 1, the first column's is the highest
    number = {tuple(s): sum(1 << (len(bits) - 1 - i) for i, c in enumerate(bits) if c not in s) for s in sets}
    by_source, by_id = grouped.filter(F.col("g") == number["source",]), grouped.filter((F.col("g") == number["id",]) & F.col("id").isNotNull())
    ids = by_id.withColumn("own", F.array_sort(F.array_distinct(F.transform("held", lambda h: h["source"]))))
    every = F.array(*[F.lit(s) for s in sources])

    def section(number: int, df: DataFrame, label: Column, source: Column, value: Column) -> DataFrame:
        return df.select(F.lit(number).alias("section"), label.cast("string").alias("label"), source.cast("string").alias("source"), value.cast("string").alias("value"))

    zero = F.lit(0).cast("long")
    counts = {"total": F.col("total"), "with id": F.col("with_id"), "without id": F.col("total") - F.col("with_id")}
    each = by_source.select("source", F.explode(F.array(*[F.struct(F.lit(n).alias("m"), c.alias("v")) for n, c in counts.items()])).alias("x"))
    unique = ids.agg(F.count("*").alias("n"))
    parts = [section(1, each, F.col("x.m"), F.col("source"), F.col("x.v")), section(1, unique, F.lit("total"), F.lit(UNIQUE), F.col("n"))]

    # ids by the sources that have them, of which there are few
    owners = ids.groupBy("own").agg(F.count("*").alias("n"))
    grid = grouped.sparkSession.range(1).select(F.explode(every).alias("a")).select("a", F.explode(every).alias("b"))
    pairs = owners.select(F.explode("own").alias("a"), "own", "n").select("a", F.explode("own").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
    parts.append(section(2, grid.join(pairs, ["a", "b"], "left"), F.col("a"), F.col("b"), F.coalesce("n", zero)))
    alone = owners.filter(F.size("own") == 1).select(F.get("own", F.lit(0)).alias("a"), "n")
    parts.append(section(3, grid.select("a").distinct().join(alone, "a", "left"), F.lit("exclusive"), F.col("a"), F.coalesce("n", zero)))

    for i, dim in enumerate(dims, 4):
        found = grouped.filter(F.col("g") == number["source", dim]).select(F.col(dim).alias("label"), "source", "total")
        labels = found.select("label").distinct().select("label", F.explode(every).alias("source"))
        parts.append(section(i, labels.join(found, ["label", "source"], "left"), F.col("label"), F.col("source"), F.coalesce("total", zero)))

    shares = by_source.select("source", F.explode(F.array(*[F.struct(F.lit(n).alias("m"), F.concat_ws("/", f"flag{i}", "total").alias("v")) for i, n in enumerate(flags)])).alias("x"))
    parts.append(section(7, shares, F.col("x.m"), F.col("source"), F.col("x.v")))
    best = ids.filter("sponsor IS NOT NULL").groupBy("sponsor").agg(F.count("*").alias("n"), F.min("seen").alias("seen")).orderBy(F.desc("n"), "seen", "sponsor").limit(limit)
    parts.append(section(8, best, F.col("sponsor"), F.lit(""), F.col("n")))
    odd = ids.filter(F.size(F.array_distinct(F.transform("held", lambda h: h["status"]))) > 1)
    status = lambda s: F.array_min(F.transform(F.filter("held", lambda h: h["source"] == s), lambda h: h["status"]))
    shown = odd.select("id", F.explode(F.transform(every, lambda s: F.struct(s.alias("s"), F.coalesce(status(s), F.lit(missing)).alias("v")))).alias("x"))
    parts.append(section(9, shown, F.col("id"), F.col("x.s"), F.col("x.v")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
