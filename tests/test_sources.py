import json

import pytest
from pyspark.sql import functions as F

from trialframe.operators import annotate, outline, patients, trials
from trialframe.sources import collections, registry, sheets
from trialframe.streaming import incremental

XML = """<?xml version="1.0"?>
<ALL>
  <PROTOCOL>
    <ID>7</ID><NO>2021.900</NO><NCT_NUMBER>NCT00000001</NCT_NUMBER><STATUS>OPEN TO ACCRUAL</STATUS><TITLE> Short </TITLE><FULL_TITLE>Long</FULL_TITLE>
    <SPONSOR_TYPE>Industry</SPONSOR_TYPE><AGE_GROUP>Adults</AGE_GROUP><PHASE>I</PHASE><DISEASE_SITE>Skin; Liver</DISEASE_SITE><LAY_DESCRIPTION/><PI>Doe, Jo</PI>
    <ELIGIBILITY>Inclusion Criteria||~First.||~Second.||~~Sub.||~Third.||Exclusion Criteria||~Fourth.</ELIGIBILITY>
    <CATEGORYS><CATEGORY><CAT1>Breast</CAT1><CAT2>x</CAT2></CATEGORY><CATEGORY><CAT1/></CATEGORY></CATEGORYS>
    <SATELLITE_SITES><SITE>A</SITE><SITE>B</SITE></SATELLITE_SITES>
  </PROTOCOL>
  <PROTOCOL><ID>8</ID><NO>2021.901</NO><CATEGORYS/></PROTOCOL>
</ALL>
"""
STUDY = {
    "protocolSection": {
        "identificationModule": {"nctId": "NCT00000002", "briefTitle": "b"},
        "statusModule": {"overallStatus": "RECRUITING"},
        "designModule": {"phases": ["PHASE1", "PHASE2"]},
        "conditionsModule": {"conditions": ["Melanoma"]},
        "armsInterventionsModule": {"interventions": [{"type": "DRUG", "name": "d1"}, {"type": "DEVICE", "name": "x"}, {"type": "BIOLOGICAL", "name": ""}]},
        "eligibilityModule": {"sex": "FEMALE", "minimumAge": "18 Years", "stdAges": ["ADULT"], "eligibilityCriteria": "Inclusion Criteria:\n* a"},
        "contactsLocationsModule": {"overallOfficials": [{"role": "CHAIR", "name": "n"}, {"role": "PRINCIPAL_INVESTIGATOR", "name": "pi"}]},
    }
}


@pytest.fixture
def xml(tmp_path):
    (tmp_path / "r.xml").write_text(XML)
    return str(tmp_path / "r.xml")


def test_registry_to_trials(spark, xml):
    raw = registry.read_registry_xml(spark, xml)
    first = raw.orderBy("protocol_no").head()
    assert first.title == "Short" and first.lay_description is None and first.satellite_sites == ["A", "B"]
    assert [tuple(c) for c in first.categories] == [("Breast", "x", "")]
    out = {r.trial_key: r for r in trials.normalize_registry(raw, spark).collect()}
    one = out["2021.900"]
    assert (one.nct_id, one.status, one.entity) == ("NCT00000001", "open to accrual", "amc")
    assert [json.loads(x) for x in one.treatment_list.step[0].match] == [{"clinical": {"age_numerical": ">=18"}}, {"clinical": {"oncotree_primary_diagnosis": "Breast"}}]
    assert one._summary.disease_keywords == ["Skin", "Liver"] and one._summary.phase == "Phase I" and one._summary.investigator.full_name == "Doe, Jo"
    assert json.loads(one._raw)["title"] == "Short" and len(one.trial_hash) == 64
    assert out["2021.901"].treatment_list.step[0].match == [] and out["2021.901"]._summary.status[0].value == ""
    criteria = outline.parse_outline_tilde(raw, "protocol_no", "eligibility").filter("source = 'inclusion'").orderBy("pos").collect()
    assert [(r.text, r.parent_pos) for r in criteria] == [("First.", None), ("Second.", None), ("Sub.", 2), ("Third.", None)]


def test_three_shapes_of_studies(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"nct_id": "NCT00000009", "phases": ["PHASE3"]}]))
    (tmp_path / "b.json").write_text(json.dumps({"studies": [STUDY]}))
    (tmp_path / "c.json").write_text(json.dumps(STUDY))
    studies = registry.read_studies(spark, str(tmp_path))
    assert sorted(r.nct_id for r in studies.collect()) == ["NCT00000002", "NCT00000002", "NCT00000009"]
    trial = trials.normalize_studies(studies.filter("principal_investigator = 'pi'")).head()
    assert trial.protocol_no is None and trial._summary.drugs[0].name == "d1" and len(trial._summary.drugs) == 1
    assert json.loads(trial.treatment_list.step[0].match[0]) == {"clinical": {"age_numerical": ">=18", "gender": "Female"}}


def test_site_sheets(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c,d,e,f,g,h,i\nn,,,,,, nct 00000002 ,,p\nn2,,,,,,bad,,\nn3,,,,,,,,\n")
    good, bad = sheets.read_site_sheet_sparrow(spark, str(tmp_path / "s.csv"))
    assert [r.nct_id for r in good.collect()] == ["NCT00000002"] and [r.nct_id for r in bad.collect()] == ["bad"]
    (tmp_path / "w.csv").write_text("a,b,c,d,e,f\ng,,,,, odd id \nh,,,,,\n")
    assert [r.nct_id for r in sheets.read_site_sheet_west(spark, str(tmp_path / "w.csv")).collect()] == ["odd id"]
    (tmp_path / "c.json").write_text(json.dumps(STUDY))
    out, missing = trials.normalize_site(good, registry.read_studies(spark, str(tmp_path / "c.json")), "sparrow")
    row = out.head()
    assert row.entity == "sparrow" and json.loads(row._raw)["site"]["study_name"] == "n" and missing.count() == 0


def test_patient_sheets(spark, tmp_path):
    (tmp_path / "pt_general.csv").write_text("pt_uuid,mrn,dob,sex,metastasis_sites,\n1,M1,3/4/1960,M,\"liver, lung\",\nx,M2,,,,\n,,,,,\n2,,,,,\n")
    (tmp_path / "report_metadata.csv").write_text("report_uuid,pt_uuid,source,date_completed\n10,1,lab,2020-01-02\n11,1,lab2,2021-01-02\n12,9,lab,\n13,1,,\n")
    (tmp_path / "tempus_findings.csv").write_text("pt_uuid,report_uuid,gene,variant_type,raw_extra\n1,10,EGFR,SNV,z\n1,99,KRAS,SNV,\n9,10,X,SNV,\n")
    (tmp_path / "tumor_biomarkers.csv").write_text("pt_uuid,report_uuid,gene,variant_type,result_summary\n1,11,TMB,tumor_biomarker,none\n1,11,TMB,tumor_biomarker,TMB-Low (4.1)\n")
    data = sheets.read_patient_sheets(spark, str(tmp_path))
    assert {(r.gene, r.source) for r in data["findings"].collect()} == {("EGFR", "lab"), ("KRAS", "tempus"), ("TMB", "lab2")}
    assert sorted(r.reason[0] for r in data["rejects"].collect()) == ["pt_uuid not long", "source missing"]
    clinical = {r.SAMPLE_ID: r for r in patients.clinical_rows(data["patients"], data["metadata"], data["findings"]).collect()}
    one = clinical["M1"]
    assert (one.BIRTH_DATE, one.GENDER, one.REPORT_DATE, one.VITAL_STATUS, one.TUMOR_MUTATIONAL_BURDEN_PER_MEGABASE) == ("1960-03-04", "Male", "2021-01-02", "alive", 4.1)
    extras = {r.sample_id: r for r in patients.nested_reports(data["patients"], data["metadata"], data["findings"]).collect()}
    assert [[f.gene for f in r.findings] for r in extras["M1"].reports] == [["EGFR"], ["TMB", "TMB"]] and extras["2"].reports == []
    assert extras["M1"].reports[0].findings[0].raw == {"raw_extra": "z"} and extras["M1"].patient.metastasis_sites == ["liver", "lung"]
    assert [r.pt_uuid for r in sheets.read_patient_sheets(spark, str(tmp_path), pt_uuid=2)["patients"].collect()] == [2]


def test_matches_in_both_shapes_and_missing_master(spark, tmp_path):
    (tmp_path / "flat.json").write_text(json.dumps([{"sample_id": "1", "sort_order": [1, 2, 3, 4, 5, 6]}]))
    (tmp_path / "packed.json").write_text(json.dumps({"clinical": {}, "trial_match": [{"sample_id": "2"}, {"sample_id": "3"}]}))
    found = collections.read_matches(spark, str(tmp_path))
    assert sorted(r.sample_id for r in found.collect()) == ["1", "2", "3"]
    assert collections.read_trials(spark, str(tmp_path / "none.json")).count() == 0


def test_sinks_and_store(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, route string, tier string")
    collections.write_diff(df, str(tmp_path / "d"))
    collections.write_tiers(df, str(tmp_path / "t"))
    collections.write_collection(df, str(tmp_path / "j"), "json")
    collections.write_sectioned_report({"Source Summary": df}, str(tmp_path / "r"))
    assert (tmp_path / "d" / "route=a").is_dir() and (tmp_path / "t" / "tier=y").is_dir()
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "r" / "1_source_summary")).count() == 2
    (tmp_path / "v.json").write_text(json.dumps([{"name": "egfr"}, {"name": "EGFR"}, {}]))
    assert [r.name for r in collections.read_gene_kb(spark, str(tmp_path / "v.json")).collect()] == ["EGFR"]
    store = collections.SuggestionStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    rows = spark.createDataFrame([("k", '"v"', False, 0)], annotate.STORE_SCHEMA)
    store.append(rows)
    store.append(rows.withColumn("value_json", F.lit('"w"')).withColumn("ord", F.lit(1).cast("long")))
    assert annotate.latest(store.read()).head()["value_json"] == '"w"'


def test_annotation_stream_resumes(spark, tmp_path):
    store = collections.SuggestionStore(spark, str(tmp_path / "store"))
    calls = spark.sparkContext.accumulator(0)

    def fn(texts):
        calls.add(len(texts))
        return texts.str.upper()

    for batch in (["a", "b"], ["b", "c"]):
        spark.createDataFrame([(t, t) for t in batch], "cache_key string, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("cache_key string, text string").parquet(str(tmp_path / "in"))
        incremental.annotate_stream(stream, store, fn, str(tmp_path / "check")).awaitTermination()
    assert {r.cache_key: r.value_json for r in store.read().collect()} == {"a": "A", "b": "B", "c": "C"} and calls.value == 3
