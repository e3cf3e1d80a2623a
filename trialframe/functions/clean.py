"""Column expressions: cleaning, code maps, parsing. All stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules


def strip(c: Column) -> Column:
    """Without ASCII white space of any kind at both ends (``trim`` takes blanks only)."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def filled(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def literal_map(table: Mapping[str, str | None]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def coerce_date(c: Column) -> Column:
    """The first of three formats that fits: 2024-3-9, 9-Mar-24, 3/9/2024. Two-digit years from 69 are of the last century."""
    short = F.try_to_date(c, "d-MMM-yy")
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(
        F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d")),
        F.when(c.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{2}$"), short),
        F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "M/d/yyyy")),
    )


def split_list(c: Column, sep: str) -> Column:
    """Parts between literal separators, stripped, empty ones dropped; null gives none."""
    parts = F.transform(F.split(c, f"[{sep}]"), strip)
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def clean_registry_id(c: Column) -> Column:
    packed = F.upper(F.regexp_replace(c, r"\s+", ""))
    return F.when(packed.rlike(r"^NCT\d{8}$"), packed)


def map_code(c: Column, table: Mapping[str, str | None], key: Column | None = None, keep: bool = True) -> Column:
    """Look-up of ``key`` (the stripped upper case of ``c``); unknown values pass through unless ``keep`` is False."""
    key = F.upper(strip(c)) if key is None else key
    found = literal_map(table)[key]
    return F.coalesce(found, filled(c)) if keep else found


def phase_label(c: Column) -> Column:
    """``Phase `` before a bare phase; other words and empty values stay."""
    as_is = c.isNull() | (c == "") | F.upper(c).isin(*rules.PHASE_AS_IS) | F.lower(c).startswith("phase")
    return F.when(as_is, c).otherwise(F.concat(F.lit("Phase "), c))


def phase_set_label(phases: Column) -> Column:
    """Label of a set of phases: one as it is, several by their numerals; without a known one the first as it is."""
    order = F.array(*map(F.lit, rules.PHASES))
    labels = F.transform(F.filter(order, lambda p: F.array_contains(phases, p)), lambda p: literal_map(rules.PHASES)[p])
    numerals = F.transform(labels, lambda x: F.regexp_replace(x, r".*Phase\s*", ""))
    first = F.try_element_at(phases, F.lit(1))
    other = F.coalesce(literal_map(rules.OTHER_PHASES)[first], first)
    return F.when(F.size(labels) == 0, other).when(F.size(labels) == 1, F.try_element_at(labels, F.lit(1))).otherwise(F.concat(F.lit("Phase "), F.array_join(numerals, "/")))


def age_group(c: Column) -> Column:
    return F.coalesce(literal_map(rules.AGE_GROUP)[F.lower(c)], c)


def age_group_set(ages: Column) -> Column:
    key = F.array_join(F.array_sort(F.array_distinct(ages)), "+")
    return F.when(F.size(ages) > 0, F.coalesce(literal_map(rules.AGE_SETS)[key], F.lit("Both")))


def age_predicate(c: Column) -> Column:
    return literal_map(rules.AGE_PREDICATE)[F.lower(c)]


def min_age_predicate(c: Column) -> Column:
    years = filled(F.regexp_extract(c, r"^(?i)(\d+)\s*year", 1))
    return F.concat(F.lit(">="), years)


def trial_gender(c: Column) -> Column:
    return map_code(c, rules.TRIAL_GENDER)


def patient_gender(c: Column) -> Column:
    return map_code(c, rules.PATIENT_GENDER, F.lower(strip(c)), keep=False)


def variant_category(c: Column) -> Column:
    """(category, known): case-sensitive look-up of the stripped type."""
    key = F.coalesce(strip(c), F.lit(""))
    return F.struct(literal_map(rules.VARIANT_CATEGORY)[key].alias("category"), key.isin(*rules.VARIANT_CATEGORY).alias("known"))


def split_pair(c: Column, separators: Iterable[str] = ("::", "/", "-")) -> Column:
    """(left, right) around the first separator that occurs at all, cut once; right is null without one."""
    out = F.struct(c.alias("left"), F.lit(None).cast("string").alias("right"))
    for sep in reversed(list(separators)):
        at = F.instr(c, sep)
        left, right = strip(F.substring(c, F.lit(1), at - 1)), strip(F.substring(c, at + len(sep), F.length(c)))
        out = F.when(F.contains(c, F.lit(sep)), F.struct(left.alias("left"), right.alias("right"))).otherwise(out)
    return out


def cnv_call(summary: Column, variant_type: Column) -> Column:
    return F.coalesce(filled(summary), literal_map(rules.CNV_CALL)[variant_type])


def mmr_status(summary: Column) -> Column:
    """Deficient words first, then proficient ones, else the text; so ``unstable`` is proficient."""
    low = F.lower(summary)
    words = ["|".join(w) for w in (rules.MMR_DEFICIENT, rules.MMR_PROFICIENT)]
    return F.when(low.rlike(words[0]), rules.MMR_LABELS[0]).when(low.rlike(words[1]), rules.MMR_LABELS[1]).otherwise(summary)


def parse_first_number(c: Column) -> Column:
    return filled(F.regexp_extract(c, r"(\d+\.?\d*)", 1)).try_cast("double")


def na_to_null(c: Column) -> Column:
    return F.when(F.upper(c) != "NA", filled(c))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*map(filled, columns))


def sample_id(mrn: Column, pt_uuid: Column) -> Column:
    return first_filled(mrn, pt_uuid.cast("string"))


def trial_id(nct_id: Column, protocol_no: Column) -> Column:
    return first_filled(nct_id, protocol_no, F.lit("unknown"))


def trial_key(entity: Column, protocol_no: Column, nct_id: Column) -> Column:
    return F.when(entity == "amc", protocol_no).otherwise(nct_id)


def defaulted(c: Column, default: str = "Unknown") -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def defaulted_status(c: Column, default: str = "unknown") -> Column:
    """Only empty values get the default; blanks become the empty string."""
    return strip(F.coalesce(filled(c), F.lit(default)))


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def cache_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


def canonical_json(raw: Column, volatile: Iterable[str] = ()) -> Column:
    """A JSON object's text with keys sorted at every level, without ``volatile`` top-level fields; null for other text."""
    fields = F.from_json(raw, "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*volatile)) if volatile else fields

    def pair(k: Column) -> Column:
        name = F.to_json(F.array(k))  # quoted and escaped, in brackets
        return F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":"), F.to_json(kept[k]))

    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(kept)), pair), ","), F.lit("}"))


def content_hash(raw: Column, volatile: Iterable[str] = ("fetched_at",)) -> Column:
    """SHA-256 of a JSON object with keys sorted at every level, without fields that change at every fetch."""
    return F.sha2(canonical_json(raw, tuple(volatile)), 256)


def answer_text(c: Column) -> Column:
    """A text model's answer without code fences and the word json."""
    body = strip(c)
    fenced = body.startswith("```")
    inner = F.regexp_replace(body, r"^```[^\n]*\n", "")
    inner = strip(F.regexp_replace(inner, r"```$", ""))
    inner = F.when(inner.startswith("json"), strip(F.substring(inner, 5, 2**31 - 1))).otherwise(inner)
    return F.when(fenced, inner).otherwise(body)


def parse_json_array(c: Column) -> Column:
    """Items of a JSON list as JSON texts; anything else gives none."""
    text = answer_text(c)
    parsed = F.try_parse_json(text)
    is_list = F.schema_of_variant(parsed).startswith("ARRAY")
    items = F.from_json(F.to_json(F.when(parsed.isNotNull() & is_list, parsed)), "array<string>")
    return F.coalesce(items, F.array().cast("array<string>"))


def raw_map(columns: Iterable[str]) -> Column:
    """Name to value of the columns, nulls dropped."""
    columns = list(columns)
    if not columns:
        return F.create_map().cast("map<string,string>")
    pairs = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*[F.col(c).cast("string") for c in columns]))
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def collect_raw_map(df: DataFrame, prefix: str = "raw_", into: str = "raw") -> DataFrame:
    """Every ``prefix`` column, declared or not, gathered in one map column."""
    own = [c for c in df.columns if c.startswith(prefix)]
    return df.select(*[c for c in df.columns if c not in own], raw_map(own).alias(into))


def labelled_rows(fields: Mapping[str, Column]) -> Column:
    """(label, value, bold) in order, without null and empty values."""
    rows = [F.struct(F.lit(label).alias("label"), c.cast("string").alias("value"), F.lit(False).alias("bold")) for label, c in fields.items()]
    return F.filter(F.array(*rows), lambda r: r["value"].isNotNull() & (r["value"] != ""))


def ordered_list(ord: str, item: Column) -> Column:
    """Aggregate: the items of a group in order of ``ord`` (items may hold maps, which have no order)."""
    def by_ord(a: Column, b: Column) -> Column:
        return F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0)

    rows = F.collect_list(F.struct(F.col(ord).alias("ord"), item.alias("item")))
    return F.transform(F.array_sort(rows, by_ord), lambda x: x["item"])


def first_keyword(c: Column, rules_in_order: Iterable[tuple[str, str | None]], strategy: str = "first") -> Column:
    """Result of the first keyword that the lower-case text holds; a keyword without result ends the search.

    ``longest`` tries longer keywords first.
    """
    table = list(rules_in_order)
    if strategy == "longest":
        table.sort(key=lambda r: -len(r[0]))
    low, out = F.lower(c), F
    for keyword, value in table:
        out = out.when(F.contains(low, F.lit(keyword)), F.lit(value).cast("string"))
    return out


def validate(df: DataFrame, required: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows whose required columns are there and of their type, cast to it; rejects
    carry ``reason``, a list."""
    reasons = []
    for name, kind in required.items():
        value = F.col(name)
        missing = value.isNull() | (value.cast("string") == "")
        wrong = ~missing & value.try_cast(kind).isNull()
        reasons.append(F.when(missing, F.lit(f"{name} missing")).when(wrong, F.lit(f"{name} not {kind}")))
    checked = df.withColumn("reason", F.array_compact(F.array(*reasons)))
    good = checked.filter(F.size("reason") == 0).drop("reason")
    return good.withColumns({n: F.col(n).try_cast(k) for n, k in required.items()}), checked.filter(F.size("reason") > 0)
