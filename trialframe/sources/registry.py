"""Registry XML and public studies."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean
from ..operators import trials


def xml_reader(spark: SparkSession) -> DataFrameReader:
    """By protocols: a file is split among tasks, and a broken protocol doesn't cost those after it, as it does where the
    file is parsed as one document."""
    return spark.read.format("xml").option("rowTag", "PROTOCOL").option("nullValue", "").option("useLegacyXMLParser", True)


def read_registry_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row for each protocol, with ``categories`` (those with a first level), ``satellite_sites`` and ``ord``.

    Protocols that are no XML give rows without values; ``rejects.registry_rejects`` lists them.
    """
    raw = xml_reader(spark).schema(schemas.REGISTRY_XML).load(path)
    own = [clean.blank_to_null(F.col(tag)).alias(name) for name, tag in schemas.REGISTRY_FIELDS.items()]

    def part(c):
        return F.coalesce(clean.strip(c), F.lit(""))

    listed = F.transform("CATEGORYS.CATEGORY", lambda c: F.struct(*[part(c[f"CAT{i}"]).alias(f"cat{i}") for i in (1, 2, 3)]))
    categories = F.coalesce(F.filter(listed, lambda c: c["cat1"] != ""), F.array().cast("array<struct<cat1:string,cat2:string,cat3:string>>"))
    sites = F.coalesce("SATELLITE_SITES.SITE", F.array().cast("array<string>"))
    return raw.select(*own, categories.alias("categories"), sites.alias("satellite_sites"), F.monotonically_increasing_id().alias("ord"))


def read_studies(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Studies of JSON files in any of three shapes: flat records, search responses, single studies.

    ``kind``: ``json`` is one document or list a file, each file one task; ``jsonl``, a record a line, is split among tasks.
    """
    nested = f"struct<protocolSection: {schemas.PROTOCOL_SECTION}>"
    schema = f"{schemas.STUDY}, studies array<{nested}>, protocolSection {schemas.PROTOCOL_SECTION}"
    raw = spark.read.schema(schema).option("multiLine", kind == "json").json(path)
    flat = [c.split(" ")[0] for c in schemas.STUDY.replace("\n", " ").strip().split(", ")]
    lists = ("phases", "conditions", "std_ages", "drug_interventions")
    own = raw.filter("nct_id IS NOT NULL").select(*[F.coalesce(c, F.array().cast("array<string>")).alias(c) if c in lists else F.col(c) for c in flat])
    found = raw.filter("nct_id IS NULL AND studies IS NOT NULL").select(F.explode("studies.protocolSection").alias("s"))
    single = raw.filter("nct_id IS NULL AND studies IS NULL AND protocolSection IS NOT NULL").select(F.col("protocolSection").alias("s"))
    projected = found.union(single).select(*trials.project_study(F.col("s")), F.lit(None).cast("timestamp").alias("fetched_at"))
    return own.unionByName(projected).withColumn("ord", F.monotonically_increasing_id())
