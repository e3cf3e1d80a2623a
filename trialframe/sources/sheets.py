"""Sheet exports: one CSV file or folder for each sheet, all columns as text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean
from ..operators import patients


def read_sheet(spark: SparkSession, path: str) -> DataFrame | None:
    """A sheet with its header, or None if there is none; columns without a name and empty rows are dropped."""
    try:
        df = spark.read.option("header", True).option("multiLine", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    named = [c for c in df.columns if not c.startswith("_c")]
    return df.select(*named).dropna("all").withColumn("ord", F.monotonically_increasing_id())


def read_patient_sheets(spark: SparkSession, folder: str, pt_uuid: int | None = None) -> dict[str, DataFrame]:
    """Validated patients, metadata and findings, and the rejects of all sheets with their reasons.

    Keys: ``patients``, ``metadata``, ``findings``, ``rejects`` (sheet, reason, row). Absent sheets count as empty.
    """
    rejects = []

    def validated(name: str, required: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
        sheet = read_sheet(spark, f"{folder}/{name}.csv")
        if sheet is None:
            sheet = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", ord long")
        sheet = sheet.withColumns({c: F.lit(None).cast("string") for c in columns if c not in sheet.columns})
        good, bad = clean.validate(sheet, required)
        rejects.append(bad.select(F.lit(name).alias("sheet"), "reason", F.to_json(F.struct(*sheet.columns)).alias("row")))
        return good

    people = validated("pt_general", {"pt_uuid": "long"}, schemas.PT_GENERAL)
    people = people.filter(F.col("pt_uuid") == pt_uuid) if pt_uuid is not None else people
    people = people.withColumn("dob", clean.coerce_date(F.col("dob"))).withColumn("metastasis_sites", clean.split_list(F.col("metastasis_sites"), ","))
    metadata = validated("report_metadata", {"report_uuid": "long", "pt_uuid": "long", "source": "string"}, schemas.REPORT_METADATA)
    dates = {c: clean.coerce_date(F.col(c)) for c in schemas.REPORT_METADATA if c.startswith("date_")}
    metadata = patients.valid_only(metadata.withColumns(dates), people, "pt_uuid")
    sheets = {name: validated(name, {"pt_uuid": "long", "report_uuid": "long"}, schemas.FINDINGS) for name in schemas.FINDING_SHEETS}
    numbered = {name: sheet.withColumn("ord", F.struct(F.lit(i).alias("sheet"), "ord")) for i, (name, sheet) in enumerate(sheets.items())}
    findings = patients.valid_only(patients.united_findings(numbered), people, "pt_uuid")
    findings = patients.with_source(findings, metadata)
    out = rejects[0]
    for more in rejects[1:]:
        out = out.unionByName(more)
    return {"patients": people, "metadata": metadata, "findings": findings, "rejects": out}


def _positional(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    df = spark.read.option("header", True).option("multiLine", True).csv(path)
    df = df.select(*[clean.blank_to_null(F.col(f"`{c}`")).alias(n) for c, n in zip(df.columns, names, strict=False)])
    missing = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(missing).dropna("all").withColumn("ord", F.monotonically_increasing_id()) if missing else df.dropna("all").withColumn("ord", F.monotonically_increasing_id())


def read_site_sheet_sparrow(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid registry id, rejects with a malformed one); rows without an id are skipped."""
    df = _positional(spark, path, schemas.SPARROW).withColumn("__id", clean.clean_registry_id(F.col("nct_id")))
    good = df.filter("__id IS NOT NULL").withColumn("nct_id", F.col("__id")).drop("__id")
    return good, df.filter("__id IS NULL AND nct_id IS NOT NULL").drop("__id").withColumn("reason", F.lit("malformed nct_id"))


def read_site_sheet_west(spark: SparkSession, path: str) -> DataFrame:
    """Rows with an id, which isn't checked."""
    return _positional(spark, path, schemas.WEST).filter("nct_id IS NOT NULL")
