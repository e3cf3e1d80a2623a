"""Patients: validated sheets to clinical, genomic and extras tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, rules
from . import lifecycle

#: a pair without its left part, by the separators of ``clean.split_pair``
NO_LEFT = r"(?s)^\s*(::|/(?!.*::)|-(?!.*(::|/)))"
FINDING_FIELDS = ("gene", "protein", "nucleotide", "variant_type", "result_summary")


def valid_only(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the parents."""
    return df.join(parents.select(key), key, "left_semi")


def with_source(findings: DataFrame, metadata: DataFrame, default: str = "default_source", key: str = "report_uuid", ord: str = "ord") -> DataFrame:
    """Findings with the ``source`` of their report, the last metadata row counting, else their sheet's name."""
    last = lifecycle.last_write_wins(metadata.select(key, ord, "source"), key, ord).select(key, "source")
    return findings.join(last, key, "left").withColumn("source", F.coalesce("source", default)).drop(default)


def united_findings(sheets: dict[str, DataFrame]) -> DataFrame:
    """All sheets' findings in one table; undeclared ``raw_`` columns are in ``raw``, and the sheet's name less
    ``_findings`` is in ``default_source``."""
    out = None
    for name, sheet in sheets.items():
        own = clean.collect_raw_map(sheet).withColumn("default_source", F.lit(name.removesuffix("_findings")))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def latest_date(metadata: DataFrame, key: str = "pt_uuid", date: str = "date_completed") -> DataFrame:
    return metadata.groupBy(key).agg(F.max(date).alias("report_date"))


def first_parseable(findings: DataFrame, key: str = "pt_uuid", ord: str = "ord") -> DataFrame:
    """(key, tmb): the first tumour-burden value that holds a number, in order of findings."""
    value = clean.parse_first_number(F.col("result_summary"))
    rows = findings.filter(F.upper("gene").isin(*rules.TMB_GENES)).withColumn("__tmb", value).filter("__tmb IS NOT NULL")
    return rows.groupBy(key).agg(F.min_by("__tmb", ord).alias("tmb"))


def clinical_rows(patients: DataFrame, metadata: DataFrame, findings: DataFrame) -> DataFrame:
    """One row for each patient in the clinical schema."""
    joined = patients.join(latest_date(metadata), "pt_uuid", "left").join(first_parseable(findings), "pt_uuid", "left")
    return joined.select(
        clean.sample_id(F.col("mrn"), F.col("pt_uuid")).alias("SAMPLE_ID"),
        F.col("oncotree_primary_diagnosis").alias("ONCOTREE_PRIMARY_DIAGNOSIS_NAME"),
        F.col("primary_dx").alias("PRIMARY_DIAGNOSIS_RAW"),
        F.date_format("dob", "yyyy-MM-dd").alias("BIRTH_DATE"),
        clean.first_filled(F.col("vital_status"), F.lit("alive")).alias("VITAL_STATUS"),
        clean.patient_gender(F.col("sex")).alias("GENDER"),
        F.col("tmb").alias("TUMOR_MUTATIONAL_BURDEN_PER_MEGABASE"),
        F.date_format("report_date", "yyyy-MM-dd").alias("REPORT_DATE"),
        F.current_timestamp().alias("_updated"),
    )


def genomic_rows(patients: DataFrame, findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genomic, rejects): one row for each finding with a category and a gene; rejects have types that no rule knows.

    The categories are a table of some twenty rows, which is broadcast, so that no row evaluates a map of them.
    """
    kinds = findings.sparkSession.createDataFrame(list(rules.VARIANT_CATEGORY.items()), "__vt string, __category string").withColumn("__known", F.lit(True))
    gene_upper = F.upper(F.coalesce("gene", F.lit("")))
    rows = findings.withColumn("__vt", clean.strip(F.coalesce("variant_type", F.lit(""))))
    rows = rows.filter(~(F.col("__vt").isin(*rules.BIOMARKER) & gene_upper.isin(*rules.TMB_GENES)))
    gene, fusion = F.coalesce("gene", F.lit("")), F.col("__vt").isin(*rules.FUSION)
    rows = rows.join(patients.select("pt_uuid", "mrn"), "pt_uuid").join(F.broadcast(kinds), "__vt", "left")
    rejects = rows.filter("__known IS NULL").select(*findings.columns, F.concat(F.lit("unknown variant_type "), F.col("__vt")).alias("reason"))
    # no gene, or nothing before the separator of a pair: said of the gene's text alone, since Spark moves filters to the scan
    named = (gene != "") & ~(fusion & gene.rlike(NO_LEFT))
    known = rows.filter(F.col("__category").isNotNull() & named).withColumns({"__pair": F.when(fusion, clean.split_pair(F.col("gene"))), "__upper": gene_upper})
    pair, signature, summary = F.col("__pair"), F.col("__category") == "SIGNATURE", F.coalesce("result_summary", F.lit(""))

    def status(genes: tuple[str, ...], value):
        return F.when(signature & F.col("__upper").isin(*genes), value)

    known = known.select(
        clean.sample_id(F.col("mrn"), F.col("pt_uuid")).alias("SAMPLE_ID"),
        F.when(pair.isNotNull(), pair["left"]).otherwise(F.col("gene")).alias("TRUE_HUGO_SYMBOL"),
        F.col("__category").alias("VARIANT_CATEGORY"),
        F.col("__vt").isin(*rules.WILDTYPE).alias("WILDTYPE"),
        clean.na_to_null(F.col("protein")).alias("TRUE_PROTEIN_CHANGE"),
        clean.na_to_null(F.col("nucleotide")).alias("TRUE_CDNA_CHANGE"),
        pair["left"].alias("LEFT_PARTNER_GENE"),
        pair["right"].alias("RIGHT_PARTNER_GENE"),
        F.when(F.col("__category") == "CNV", clean.cnv_call(F.col("result_summary"), F.col("__vt"))).alias("CNV_CALL"),
        status(rules.MMR_GENES, clean.mmr_status(summary)).alias("MMR_STATUS"),
        status(rules.POLE_GENES, summary).alias("POLE_STATUS"),
        status(rules.APOBEC_GENES, summary).alias("APOBEC_STATUS"),
        status(rules.TOBACCO_GENES, summary).alias("TOBACCO_STATUS"),
        F.current_timestamp().alias("_updated"),
    )
    return known, rejects


def unknown_types(rejects: DataFrame) -> DataFrame:
    """One row: the distinct types that were skipped, sorted."""
    return rejects.agg(F.array_sort(F.collect_set("variant_type")).alias("variant_types"))


def nested_reports(patients: DataFrame, metadata: DataFrame, findings: DataFrame, ord: str = "ord") -> DataFrame:
    """Extras: (sample_id, patient, reports), reports in order with their findings in order. Findings of
    reports without metadata are left out."""
    finding = F.struct(*FINDING_FIELDS, "raw")
    per_report = findings.groupBy("pt_uuid", "report_uuid").agg(clean.ordered_list(ord, finding).alias("findings"))
    joined = metadata.join(per_report, ["pt_uuid", "report_uuid"], "left")
    empty = F.array().cast(per_report.schema["findings"].dataType)
    date = F.date_format("date_completed", "yyyy-MM-dd").alias("date_completed")
    report = F.struct("source", "test_name", "accession_no", "physician", date, F.coalesce("findings", empty).alias("findings"))
    per_patient = joined.groupBy("pt_uuid").agg(clean.ordered_list(ord, report).alias("reports"))
    none = F.array().cast(per_patient.schema["reports"].dataType)
    own = [c for c in patients.columns if c != ord]
    out = patients.join(per_patient, "pt_uuid", "left")
    return out.select(clean.sample_id(F.col("mrn"), F.col("pt_uuid")).alias("sample_id"), F.struct(*own).alias("patient"), F.coalesce("reports", none).alias("reports"))
