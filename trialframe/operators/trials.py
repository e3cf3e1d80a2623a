"""Trials of four feeds in one document shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean, rules
from . import nodes, vocab

STRINGS = "array<string>"


def project_study(section: Column) -> list[Column]:
    """The flat study columns from a nested protocol section."""

    def listed(c: Column) -> Column:
        return F.coalesce(c, F.array().cast(STRINGS))

    officials = section["contactsLocationsModule"]["overallOfficials"]
    investigators = F.filter(officials, lambda o: o["role"] == "PRINCIPAL_INVESTIGATOR")
    interventions = section["armsInterventionsModule"]["interventions"]
    drugs = F.filter(interventions, lambda i: i["type"].isin("DRUG", "BIOLOGICAL") & clean.filled(i["name"]).isNotNull())
    ident, elig = section["identificationModule"], section["eligibilityModule"]
    return [
        ident["nctId"].alias("nct_id"),
        ident["briefTitle"].alias("brief_title"),
        ident["officialTitle"].alias("official_title"),
        section["statusModule"]["overallStatus"].alias("overall_status"),
        listed(section["designModule"]["phases"]).alias("phases"),
        section["sponsorCollaboratorsModule"]["leadSponsor"]["name"].alias("lead_sponsor"),
        section["descriptionModule"]["briefSummary"].alias("brief_summary"),
        listed(section["conditionsModule"]["conditions"]).alias("conditions"),
        elig["sex"].alias("sex"),
        elig["minimumAge"].alias("minimum_age"),
        elig["maximumAge"].alias("maximum_age"),
        listed(elig["stdAges"]).alias("std_ages"),
        elig["eligibilityCriteria"].alias("eligibility_criteria"),
        F.try_element_at(investigators, F.lit(1))["name"].alias("principal_investigator"),
        listed(F.transform(drugs, lambda d: d["name"])).alias("drug_interventions"),
    ]


def trial_summary(status: Column, short: Column, long: Column, phase: Column, sponsor: Column, age: Column, gender: Column, keywords: Column, drugs: Column, investigator: Column) -> Column:
    """The display struct; a missing status is the empty string, a missing investigator null."""
    person = F.when(clean.filled(investigator).isNotNull(), F.struct(investigator.alias("full_name")))
    return F.struct(
        F.array(F.struct(F.coalesce(status, F.lit("")).alias("value"))).alias("status"),
        short.alias("short_title"),
        long.alias("long_title"),
        phase.alias("phase"),
        sponsor.alias("sponsor"),
        age.alias("age"),
        gender.alias("gender"),
        keywords.alias("disease_keywords"),
        F.transform(drugs, lambda d: F.struct(d.alias("name"))).alias("drugs"),
        person.alias("investigator"),
        F.array().cast(STRINGS).alias("prior_treatment_requirements"),
    )


def seed_nodes(age: Column, gender: Column, diagnoses: Column) -> Column:
    """Match nodes as JSON texts: age and gender (other than All) in one clinical node, then the diagnoses."""
    own_gender = F.when(gender != "All", gender)
    clinical = F.to_json(F.struct(F.struct(age.alias("age_numerical"), own_gender.alias("gender")).alias("clinical")))
    return F.array_compact(F.array(F.when(age.isNotNull() | own_gender.isNotNull(), clinical), nodes.diagnoses_to_node(diagnoses)))


def treatment_list(match: Column) -> Column:
    """One step with the nodes and one stub arm."""
    empty = F.array().cast(STRINGS)
    level = "array<struct<level_internal_id:int,level_code:string,level_suspended:string,level_description:string,match:array<string>>>"
    arm = F.struct(F.lit(1).alias("arm_internal_id"), F.lit("ARM 1").alias("arm_code"), F.lit("Enrollment").alias("arm_description"), F.lit("N").alias("arm_suspended"), empty.alias("match"), F.array().cast(level).alias("dose_level"))
    step = F.struct(F.lit(1).alias("step_internal_id"), F.lit("1").alias("step_code"), F.lit("Registration").alias("step_type"), match.alias("match"), F.array(arm).alias("arm"))
    return F.struct(F.array(step).alias("step"))


def _trial(df: DataFrame, protocol_no: Column, nct_id: Column, status: Column, entity: Column, match: Column, summary: Column, raw: Column) -> DataFrame:
    rows = df.select(protocol_no.alias("protocol_no"), nct_id.alias("nct_id"), status.alias("status"), entity.alias("entity"), treatment_list(match).alias("treatment_list"), summary.alias("_summary"), raw.alias("_raw"), "ord")
    key = clean.trial_key(F.col("entity"), F.col("protocol_no"), F.col("nct_id"))
    return rows.select(key.alias("trial_key"), "protocol_no", "nct_id", "status", "entity", clean.content_hash(F.col("_raw")).alias("trial_hash"), "ord", "treatment_list", "_summary", "_raw")


def normalize_registry(registry: DataFrame, spark: SparkSession) -> DataFrame:
    """Trials of the registry feed (columns of ``sources.registry.read_registry_xml``)."""
    names = vocab.category_diagnoses(registry.filter("size(categories) > 0"), spark, key="ord")
    df = registry.join(names, "ord", "left").withColumn("diagnoses", F.coalesce("diagnoses", F.array().cast(STRINGS)))
    status, phase = clean.map_code(F.col("status"), rules.REGISTRY_STATUS), clean.phase_label(F.col("phase"))
    age = F.coalesce(clean.literal_map(rules.AGE_GROUP)[F.lower(clean.strip("age_group"))], F.col("age_group"))
    none = F.array().cast(STRINGS)
    summary = trial_summary(status, F.col("title"), F.col("full_title"), phase, F.col("sponsor_type"), age, F.lit("All"), clean.split_list(F.col("disease_site"), ";"), none, F.col("pi"))
    match = seed_nodes(clean.age_predicate(clean.strip("age_group")), F.lit("All"), F.col("diagnoses"))
    raw = F.to_json(F.struct(*[c for c in registry.columns if c != "ord"]))
    return _trial(df, F.col("protocol_no"), F.col("nct_number"), status, F.lit("amc"), match, summary, raw)


def normalize_studies(studies: DataFrame, entity: str = "ctgov", extra: list[str] | None = None) -> DataFrame:
    """Trials of the public feed; ``extra`` columns go into ``_raw`` besides the study's own."""
    status, phase = clean.map_code(F.col("overall_status"), rules.STUDY_STATUS), clean.phase_set_label(F.col("phases"))
    gender, age = clean.trial_gender(F.col("sex")), clean.age_group_set(F.col("std_ages"))
    summary = trial_summary(status, F.col("brief_title"), F.col("official_title"), phase, F.col("lead_sponsor"), age, gender, F.col("conditions"), F.col("drug_interventions"), F.col("principal_investigator"))
    match = seed_nodes(clean.min_age_predicate(F.col("minimum_age")), gender, vocab.condition_diagnoses(F.col("conditions")))
    own = [c for c in studies.columns if c != "ord" and c not in (extra or [])]
    raw = F.to_json(F.struct(*own, *(extra or [])))
    return _trial(studies, F.lit(None).cast("string"), F.col("nct_id"), status, F.lit(entity), match, summary, raw)


def site_enrich(sheet: DataFrame, studies: DataFrame, key: str = "nct_id") -> tuple[DataFrame, DataFrame]:
    """(rows with their study, rows without one). The sheet's other columns are in ``site``."""
    site = F.struct(*[c for c in sheet.columns if c not in (key, "ord")])
    found = sheet.select(key, "ord", site.alias("site")).join(studies.drop("ord"), key)
    return found, sheet.join(studies.select(key), key, "left_anti")


def normalize_site(sheet: DataFrame, studies: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(trials, rejects) of a site's sheet: the public study under the site's entity, the sheet's row within ``_raw``."""
    found, missing = site_enrich(sheet, studies)
    return normalize_studies(found, entity, extra=["site"]), missing.withColumn("reason", F.lit("no study with this id"))


def united_feeds(*feeds: DataFrame) -> DataFrame:
    """All feeds in one table, by column name."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    return out


def selected(trials: DataFrame, ids: list[str] | None = None, limit: int | None = None, key: str = "trial_key", ord: str = "ord") -> DataFrame:
    """Trials of a list of ids, or else the first ``limit`` in order, or all."""
    if ids:
        return trials.filter(F.col(key).isin(*ids))
    return trials.orderBy(ord).limit(limit) if limit else trials


EMPTY_TRIALS = schemas.TRIAL
