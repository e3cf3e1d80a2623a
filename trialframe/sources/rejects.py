"""Records that the readers can't use, as tables: (file, record, reason).

The readers of studies, registry XML and matches leave such records out; these functions list them from the same files, so that
good and rejected records together are all records. A missing record text means that the file has none to show. Empty files and tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean
from .registry import xml_reader

CORRUPT = "_corrupt"


def _listed(raw: DataFrame, reason: Column) -> DataFrame:
    # the text of a broken record can be asked for only together with other columns
    seen = F.to_json(F.struct(*[c for c in raw.columns if c != CORRUPT]))
    rows = raw.select(F.col("_metadata.file_name").alias("file"), F.coalesce(CORRUPT, seen).alias("record"), reason.alias("reason"))
    return rows.filter("reason IS NOT NULL")


def _json(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", kind == "json").json(path)


def _malformed() -> Column:
    return F.when(F.col(CORRUPT).isNotNull(), "malformed")


def study_rejects(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Of files that ``read_studies`` reads: text that is no JSON of the expected types, and records without an id or a study."""
    nested = f"struct<protocolSection: {schemas.PROTOCOL_SECTION}>"
    raw = _json(spark, path, f"{schemas.STUDY}, studies array<{nested}>, protocolSection {schemas.PROTOCOL_SECTION}", kind)
    nothing = F.col("nct_id").isNull() & F.col("studies").isNull() & F.col("protocolSection").isNull()
    return _listed(raw, _malformed().when(nothing, "no study"))


def match_rejects(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Of files that ``read_matches`` reads: text that is no JSON of the expected types, and matches without a sample."""
    raw = _json(spark, path, f"{schemas.TRIAL_MATCH}, trial_match array<struct<{schemas.TRIAL_MATCH.replace(chr(10), ' ').strip()}>>", kind)
    nobody = F.col("trial_match").isNull() & clean.filled(F.col("sample_id")).isNull()
    return _listed(raw, _malformed().when(nobody, "no sample"))


def registry_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Of files that ``read_registry_xml`` reads: protocols that are no XML, and those without a number of either kind."""
    raw = xml_reader(spark).option("columnNameOfCorruptRecord", CORRUPT).schema(f"{schemas.REGISTRY_XML.strip()}, {CORRUPT} string").load(path)
    unnamed = clean.blank_to_null(F.col("NO")).isNull() & clean.blank_to_null(F.col("NCT_NUMBER")).isNull()
    return _listed(raw, _malformed().when(unnamed, "no number"))
