"""Schemas of the tables that the library reads and makes, as Spark DDL.

Column names and XML tags are fixed values: those of the files and collections that are read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with more columns."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


REGISTRY_XML = """
ID string, NO string, NCT_NUMBER string, STATUS string, TITLE string, FULL_TITLE string, SUMMARY_OBJ string,
SECONDARY_PROTOCOL_NO string, SPONSOR_TYPE string, AGE_GROUP string, PHASE string, CANCER_PREVENTION string, SCOPE string,
DISEASE_SITE string, LAY_DESCRIPTION string, PI string, INSTITUTIONS string, ONCOLOGY_GROUP string, MANAGEMENT_GROUP string,
SUMMARY4_TYPE string, OCTSU_GENES_INTEREST string, ELIGIBILITY string,
CATEGORYS struct<CATEGORY: array<struct<CAT1:string, CAT2:string, CAT3:string>>>,
SATELLITE_SITES struct<SITE: array<string>>
"""

#: registry column: XML tag
REGISTRY_FIELDS = {
    "amc_id": "ID",
    "protocol_no": "NO",
    "nct_number": "NCT_NUMBER",
    "status": "STATUS",
    "title": "TITLE",
    "full_title": "FULL_TITLE",
    "summary_obj": "SUMMARY_OBJ",
    "secondary_protocol_no": "SECONDARY_PROTOCOL_NO",
    "sponsor_type": "SPONSOR_TYPE",
    "age_group": "AGE_GROUP",
    "phase": "PHASE",
    "cancer_prevention": "CANCER_PREVENTION",
    "scope": "SCOPE",
    "disease_site": "DISEASE_SITE",
    "lay_description": "LAY_DESCRIPTION",
    "pi": "PI",
    "institutions": "INSTITUTIONS",
    "oncology_group": "ONCOLOGY_GROUP",
    "management_group": "MANAGEMENT_GROUP",
    "summary4_type": "SUMMARY4_TYPE",
    "octsu_genes_interest": "OCTSU_GENES_INTEREST",
    "eligibility": "ELIGIBILITY",
}

STUDY = """
nct_id string, brief_title string, official_title string, overall_status string, phases array<string>, lead_sponsor string,
brief_summary string, conditions array<string>, sex string, minimum_age string, maximum_age string, std_ages array<string>,
eligibility_criteria string, principal_investigator string, drug_interventions array<string>, fetched_at timestamp
"""

#: the nested form of a study
PROTOCOL_SECTION = """
struct<identificationModule: struct<nctId:string, briefTitle:string, officialTitle:string>,
statusModule: struct<overallStatus:string>,
sponsorCollaboratorsModule: struct<leadSponsor: struct<name:string>>,
descriptionModule: struct<briefSummary:string>,
conditionsModule: struct<conditions: array<string>>,
designModule: struct<phases: array<string>>,
armsInterventionsModule: struct<interventions: array<struct<type:string, name:string>>>,
eligibilityModule: struct<sex:string, minimumAge:string, maximumAge:string, stdAges: array<string>, eligibilityCriteria:string>,
contactsLocationsModule: struct<overallOfficials: array<struct<role:string, name:string>>>>
"""

SPARROW = ("study_name", "description", "contact_name", "contact_phone", "trial_category", "trial_subcategory", "nct_id", "contact_email", "pi")
WEST = ("group", "disease_category", "sponsor", "title", "protocol_id", "nct_id")

PT_GENERAL = ("pt_uuid", "mrn", "first_name", "last_name", "dob", "sex", "vital_status", "entity", "primary_dx", "oncotree_primary_diagnosis", "metastasis_sites")
REPORT_METADATA = ("report_uuid", "pt_uuid", "source", "test_name", "accession_no", "physician", "specimen_type", "date_collected", "date_received", "date_completed", "obtained_from", "link", "notes")
FINDINGS = ("pt_uuid", "report_uuid", "gene", "protein", "nucleotide", "variant_type", "result_summary")
FINDING_SHEETS = ("tempus_findings", "caris_findings", "ambry_findings", "amc_ngs_findings", "ogm_findings", "pml_rara_findings", "tumor_biomarkers")

TREATMENT_LIST = """
struct<step: array<struct<step_internal_id:int, step_code:string, step_type:string, match: array<string>,
arm: array<struct<arm_internal_id:int, arm_code:string, arm_description:string, arm_suspended:string, match: array<string>,
dose_level: array<struct<level_internal_id:int, level_code:string, level_suspended:string, level_description:string, match: array<string>>>>>>>>
"""
SUMMARY = """
struct<status: array<struct<value:string>>, short_title:string, long_title:string, phase:string, sponsor:string, age:string, gender:string,
disease_keywords: array<string>, drugs: array<struct<name:string>>, investigator: struct<full_name:string>,
prior_treatment_requirements: array<string>>
"""
TRIAL = f"trial_key string, protocol_no string, nct_id string, status string, entity string, trial_hash string, ord long, treatment_list {TREATMENT_LIST}, _summary {SUMMARY}, _raw string"

TRIAL_MATCH = """
sample_id string, protocol_no string, nct_id string, trial_summary_status string, match_level string, reason_type string,
match_type string, cancer_type_match string, code string, show_in_ui boolean, sort_order array<int>, true_hugo_symbol string,
true_protein_change string, true_cdna_change string, true_variant_classification string, variant_category string,
genomic_alteration string, allele_fraction double, tier string, chromosome string, position int, reference_allele string
"""
