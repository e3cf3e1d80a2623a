"""Best and other matches of every sample, and their report context. All samples at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean, rules

DEFAULT_ORDER = [99] * 6


def match_priority() -> list[Column]:
    """Arm matches before others, genomic reasons before others, then the given order (missing: last)."""
    order = F.when(F.size("sort_order") > 0, F.col("sort_order")).otherwise(F.array(*map(F.lit, DEFAULT_ORDER)))
    level, reason = (F.when(F.col(c).eqNullSafe(v), 0).otherwise(1) for c, v in (("match_level", "arm"), ("reason_type", "genomic")))
    return [level, reason, order]


def visible(matches: DataFrame) -> DataFrame:
    return matches.filter(F.coalesce("show_in_ui", F.lit(False)))


def primary_match(matches: DataFrame, by: str, priority: list[Column], ord: list[str]) -> DataFrame:
    """The row of each ``by`` with the least priority, then the least ``ord``. Rows are thinned out before the shuffle, by a
    sort-based aggregation (its buffer is a whole row)."""
    rank = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(priority)], *ord)
    return matches.groupBy(by).agg(F.min_by(F.struct(*matches.columns), rank).alias("row")).select("row.*")


def numbered_matches(matches: DataFrame, by: str, group: str, priority: list[Column], ord: list[str]) -> DataFrame:
    """``matches`` with ``number``: of the first row of each non-empty ``group`` of a ``by``, without the group of the primary match, its
    number in order; null for all other rows. Rows are dealt out by ``by`` once, and stay there; a null ``by`` has no numbers.
    The primary's group is found after the rows are sorted by group: it needs no sort of its own, and the sorts don't hold the ranks."""
    own = Window.partitionBy(by)
    rank = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(priority)], *ord)
    rows = matches.repartition(by).withColumn("__nth", F.row_number().over(Window.partitionBy(by, group).orderBy(*ord)))
    rows = rows.withColumn("__taken", F.min_by(F.struct(F.col(group).alias("g")), rank).over(own)["g"])
    other = (F.col("__nth") == 1) & F.col(by).isNotNull() & clean.filled(F.col(group).cast("string")).isNotNull() & ~F.col(group).eqNullSafe(F.col("__taken"))
    rows = rows.withColumn("__other", F.coalesce(other, F.lit(False)))
    number = F.when(F.col("__other"), F.row_number().over(Window.partitionBy(by, "__other").orderBy(*ord)))
    return rows.withColumn("number", number).drop("__taken", "__nth", "__other")


def other_matches(matches: DataFrame, by: str, group: str, priority: list[Column], ord: list[str]) -> DataFrame:
    """The first row of each non-empty ``group`` of a ``by``, without the primary's group, with its number in order."""
    return numbered_matches(matches, by, group, priority, ord).filter("number IS NOT NULL")


def trim_referenced(trials: DataFrame, matches: DataFrame, key: str = "protocol_no") -> DataFrame:
    """Trials that some match refers to."""
    return trials.join(matches.select(key), key, "left_semi")


def match_context(primary: DataFrame, trials: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """(sample_id, nct_id, trial_status, trial, match_detail, genomic) of each primary match; the last three are
    labelled rows. ``trials`` has one row for each protocol_no with its ``_summary``; ``kept`` columns of ``primary`` follow."""
    t = trials.select(F.col("protocol_no").alias("__protocol"), F.col("_summary").alias("s"))
    joined = primary.join(t, F.col("protocol_no") == F.col("__protocol"), "left")
    status = clean.capitalized(F.coalesce("trial_summary_status", F.lit("")))
    trial = {
        "Trial Name": clean.first_filled(F.col("s.long_title"), F.col("s.short_title")),
        "NCT ID": F.col("nct_id"),
        "Protocol No.": F.col("protocol_no"),
        "Phase": F.col("s.phase"),
        "Investigator": F.col("s.investigator.full_name"),
        "Match Level": F.col("match_level"),
        "Trial Status": status,
        "Match Engine": F.lit(rules.MATCH_ENGINE),
    }
    detail = {"Cancer Type Match": F.col("cancer_type_match"), "Reason Type": F.col("reason_type"), "Match Type": F.col("match_type"), "Arm": F.col("code")}
    genomic = {label: F.col(c) for c, label in rules.GENOMIC_MATCH.items()}
    rows = [clean.labelled_rows(x).alias(n) for n, x in (("trial", trial), ("match_detail", detail), ("genomic", genomic))]
    return joined.select("sample_id", "nct_id", status.alias("trial_status"), *rows, *(kept or []))


def patient_context(extras: DataFrame) -> DataFrame:
    """(sample_id, patient_header, patient_detail, reports); lists in patient fields become one text."""
    kinds = dict(extras.select("patient.*").dtypes)

    def value(name: str) -> Column:
        c = F.col(f"patient.{name}") if name in kinds else F.lit(None).cast("string")
        return F.array_join(c, ", ") if kinds.get(name, "").startswith("array") else c.cast("string")

    header, detail = ({label: value(c) for c, label in fields.items()} for fields in (rules.PATIENT_HEADER, rules.PATIENT_DETAIL))
    return extras.select("sample_id", clean.labelled_rows(header).alias("patient_header"), clean.labelled_rows(detail).alias("patient_detail"), "reports")


def report_context(matches: DataFrame, trials: DataFrame, extras: DataFrame) -> DataFrame:
    """The report table: for each sample with matches or patient data its patient rows, primary match and other matches."""
    shown = numbered_matches(visible(matches), "sample_id", "protocol_no", match_priority(), ["ord"])
    rank = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(match_priority())], "ord")
    used = [c for c in matches.columns if c not in ("sample_id", "show_in_ui", "sort_order", "ord")]
    fields = ["number", "protocol_no", "nct_id", "match_level", "match_type", F.coalesce("genomic_alteration", F.lit("")).alias("genomic_alteration"), F.lit("matchminer").alias("source")]
    others = F.array_sort(F.collect_list(F.when(F.col("number").isNotNull(), F.struct(*fields))))
    best = shown.groupBy("sample_id").agg(F.min_by(F.struct(*used), rank).alias("row"), others.alias("others"))
    others = F.when(F.size("others") > 0, F.col("others"))
    context = match_context(best.select("sample_id", "row.*", others.alias("other_matches")), trials, ["other_matches"])
    main = context.select("sample_id", F.struct(*[c for c in context.columns if c not in ("sample_id", "other_matches")]).alias("primary_match"), "other_matches")
    return patient_context(extras).join(main, "sample_id", "full")
