"""Coverage, overlap and conflicts between sources. Input: one row per record with ``source`` and ``id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean


def source_summary(df: DataFrame, source: str, id: str) -> DataFrame:
    """(source, total, with_id, without_id) and a row of distinct ids over all sources."""
    per = df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("total"), F.count(id).alias("with_id"))
    per = per.withColumn("without_id", F.col("total") - F.col("with_id"))
    n = F.count_distinct(F.col(id))
    return per.unionByName(df.agg(F.lit("UNIQUE (all sources)").alias("source"), n.alias("total"), n.alias("with_id"), F.lit(None).cast("long").alias("without_id")))


def source_ids(df: DataFrame, source: str, id: str) -> DataFrame:
    return df.filter(F.col(id).isNotNull()).select(F.col(source).alias("source"), F.col(id).alias("id")).distinct()


def overlap_matrix(df: DataFrame, source: str, id: str) -> DataFrame:
    """(a, b, n): ids common to each ordered pair of sources, zeros included.

    Each id becomes its set of sources, which has few distinct values, so pairs are made of sets, not ids.
    """
    sets = source_ids(df, source, id).groupBy("id").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    sets = sets.groupBy("sources").agg(F.count("*").alias("n"))
    pairs = sets.select(F.explode("sources").alias("a"), "sources", "n").select("a", F.explode("sources").alias("b"), "n")
    names = df.select(F.col(source).alias("a")).distinct()
    grid = names.join(names.select(F.col("a").alias("b")), F.lit(True))  # source names only
    found = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return grid.join(found, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def exclusive_ids(df: DataFrame, source: str, id: str) -> DataFrame:
    """(source, n): ids that no other source has, for every source."""
    alone = source_ids(df, source, id).groupBy("id").agg(F.min("source").alias("source"), F.count("*").alias("k")).filter("k = 1")
    counts = alone.groupBy("source").agg(F.count("*").alias("n"))
    names = df.select(F.col(source).alias("source")).distinct()
    return names.join(counts, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("n"))


def crosstab(df: DataFrame, label: Column, source: str, values: list[str]) -> DataFrame:
    """One row for each label, one column for each source, zeros filled, in order of label."""
    table = df.groupBy(label.alias("label")).pivot(source, values).count()
    return table.na.fill(0, values).orderBy("label")


def completeness(df: DataFrame, source: str, flags: dict[str, Column]) -> DataFrame:
    """(source, metric, share): ``n/total`` for each flag."""
    total = F.count("*")
    shares = [F.struct(F.lit(name).alias("metric"), F.concat_ws("/", F.count_if(c), total).alias("share")) for name, c in flags.items()]
    per = df.groupBy(F.col(source).alias("source")).agg(F.array(*shares).alias("m"))
    return per.select("source", F.explode("m").alias("m")).select("source", "m.*")


def has_eligibility(inclusion: str, exclusion: str) -> Column:
    return (F.coalesce(F.size(inclusion), F.lit(0)) > 0) | (F.coalesce(F.size(exclusion), F.lit(0)) > 0)


def has_drugs(drugs: str = "_summary.drugs") -> Column:
    return F.coalesce(F.size(drugs), F.lit(0)) > 0


def match_beyond_age(steps: str = "treatment_list.step") -> Column:
    """Some step has several match nodes, or one with a clinical key other than the age or with a genomic part."""

    def one(node: Column) -> Column:
        keys = F.json_object_keys(F.get_json_object(node, "$.clinical"))
        other = F.exists(F.coalesce(keys, F.array().cast("array<string>")), lambda k: k != "age_numerical")
        genomic = F.get_json_object(node, "$.genomic")
        return other | (genomic.isNotNull() & ~genomic.isin("{}", ""))

    def beyond(step: Column) -> Column:
        match = step["match"]
        return (F.size(match) > 1) | ((F.size(match) == 1) & one(F.try_element_at(match, F.lit(1))))

    return F.coalesce(F.exists(steps, beyond), F.lit(False))


def top_sponsors(df: DataFrame, id: str, sponsor: str, source_rank: str, ord: str, limit: int = 20, default: str = "Unknown") -> DataFrame:
    """(sponsor, n): of each id the sponsor of the first source with a non-blank one (missing counts as the
    default); most frequent first, ties by first appearance."""
    named = df.filter(F.col(id).isNotNull()).withColumn("__sponsor", clean.strip(F.coalesce(clean.filled(F.col(sponsor)), F.lit(default)))).filter("__sponsor <> ''")
    per_id = named.groupBy(id).agg(F.min_by("__sponsor", F.struct(source_rank, ord)).alias("sponsor"), F.min(F.struct(source_rank, ord)).alias("seen"))
    counts = per_id.groupBy("sponsor").agg(F.count("*").alias("n"), F.min("seen").alias("seen"))
    return counts.orderBy(F.desc("n"), "seen", "sponsor").limit(limit).select("sponsor", "n")


def conflicts(df: DataFrame, id: str, source: str, value: str, values: list[str], missing: str = "—") -> DataFrame:
    """Ids whose value differs between sources: one column for each source."""
    odd = df.filter(F.col(id).isNotNull()).groupBy(id).agg(F.count_distinct(value).alias("k")).filter("k > 1").select(id)
    table = df.join(odd, id, "left_semi").groupBy(id).pivot(source, values).agg(F.first(value))
    return table.na.fill(missing, values).orderBy(id)


def source_map(df: DataFrame, id: str, source: str, ord: str) -> DataFrame:
    """(id, by_source): for each id a map from source to that source's last row; rows without an id are left out."""
    row = F.struct(*[c for c in df.columns if c not in (id, source)])
    last = df.filter(F.col(id).isNotNull()).groupBy(id, source).agg(F.max_by(row, ord).alias("row"))
    return last.groupBy(id).agg(F.map_from_entries(F.collect_list(F.struct(source, "row"))).alias("by_source"))
