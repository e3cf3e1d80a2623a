import datetime

import pytest
from pyspark.sql import functions as F

from trialframe.functions import clean, rules


def values(spark, expression, texts, kind="string"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r["v"] for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_blank_to_null_strips_all_white_space(spark):
    assert values(spark, clean.blank_to_null, ["\t a \n", " \n", "", None]) == ["a", None, None, None]


def test_coerce_date(spark):
    d = datetime.date
    texts = ["2024-3-9", "03-Mar-72", "03-Mar-68", "3/9/2024", "soon", None, "2024-13-01"]
    assert values(spark, clean.coerce_date, texts) == [d(2024, 3, 9), d(1972, 3, 3), d(2068, 3, 3), d(2024, 3, 9), None, None, None]


def test_split_list(spark):
    assert values(spark, lambda c: clean.split_list(c, ";"), [" a ;; b;", None, ""]) == [["a", "b"], [], []]


def test_registry_id(spark):
    assert values(spark, clean.clean_registry_id, [" nct 0371 5933", "NCT1", None]) == ["NCT03715933", None, None]


def test_status_maps_pass_unknown_values(spark):
    assert values(spark, lambda c: clean.map_code(c, rules.REGISTRY_STATUS), [" open to accrual", "Odd", "", None]) == ["open to accrual", "Odd", None, None]


def test_phase_label(spark):
    assert values(spark, clean.phase_label, ["I", "phase 2", "N/A", "", None]) == ["Phase I", "phase 2", "N/A", "", None]


@pytest.mark.parametrize(
    "phases, label",
    [(["PHASE1", "PHASE2"], "Phase I/II"), (["PHASE2"], "Phase II"), (["EARLY_PHASE1", "PHASE1"], "Phase I/I"), (["NA"], "N/A"), (["X"], "X"), ([], None)],
)
def test_phase_set_label(spark, phases, label):
    assert values(spark, clean.phase_set_label, [phases], "array<string>") == [label]


def test_age_groups(spark):
    assert values(spark, clean.age_group_set, [["CHILD", "ADULT"], ["OLDER_ADULT"], ["CHILD", "OLDER_ADULT"], []], "array<string>") == ["Both", "Adult", "Both", None]
    assert values(spark, clean.min_age_predicate, ["18 Years", "6 Months", "1 year", None]) == [">=18", None, ">=1", None]
    assert values(spark, clean.age_predicate, ["adults", "children", "both", None]) == [">=18", "<18", None, None]


def test_gender(spark):
    assert values(spark, clean.patient_gender, [" M", "female", "other", None]) == ["Male", "Female", None, None]
    assert values(spark, clean.trial_gender, ["all", "X", ""]) == ["All", "X", None]


def test_fusion_pairs(spark):
    found = values(spark, clean.split_pair, ["PML/RARA", "CD74-ROS1", "A-B::C/D", "X", "A/B/C"])
    assert [tuple(x) for x in found] == [("PML", "RARA"), ("CD74", "ROS1"), ("A-B", "C/D"), ("X", None), ("A", "B/C")]


def test_numbers_and_signatures(spark):
    assert values(spark, clean.parse_first_number, ["TMB-Low (4.1)", "1.6m/MB", "none", "7."]) == [4.1, 1.6, None, 7.0]
    deficient, proficient = rules.MMR_LABELS
    assert values(spark, clean.mmr_status, ["MSI-High", "pMMR", "unstable", "odd"]) == [deficient, proficient, proficient, "odd"]
    assert values(spark, clean.na_to_null, ["NA", "na", "", "p.V600E", None]) == [None, None, None, "p.V600E", None]


def test_defaults(spark):
    assert values(spark, clean.defaulted, [" ", None, " a "]) == ["Unknown", "Unknown", "a"]
    assert values(spark, clean.defaulted_status, [" ", None, ""]) == ["", "unknown", "unknown"]
    assert values(spark, clean.capitalized, ["oPEN to", ""]) == ["Open to", ""]


def test_answers(spark):
    texts = ['["a", {"b": 1}]', '```json\n["a"]\n```', "garbage", '{"a": 1}', "[]", None]
    assert values(spark, clean.parse_json_array, texts) == [["a", '{"b":1}'], ["a"], [], [], [], []]


def test_content_hash_sorts_nested_keys(spark):
    texts = ['{"a":{"x":1,"y":[{"q":1,"p":2}]},"b":null}', '{"b":null,"a":{"y":[{"p":2,"q":1}],"x":1}}', '{"a":{"x":"1","y":[{"q":1,"p":2}]},"b":null}', "[1]", "no json", None]
    hashes = values(spark, clean.content_hash, texts)
    assert hashes[0] == hashes[1] != hashes[2] and hashes[3:] == [None] * 3
    assert values(spark, clean.canonical_json, ['{"b\\"c": 1.5, "a": {"z": true, "y": {}}}', "{}"]) == ['{"a":{"y":{},"z":true},"b\\"c":1.5}', "{}"]


def test_content_hash_ignores_order_and_volatile_fields(spark):
    a, b, c = values(spark, clean.content_hash, ['{"x": 1, "y": "2", "fetched_at": "a"}', '{"y": "2", "x": 1, "fetched_at": "b"}', '{"x": 2, "y": "2"}'])
    assert a == b != c


def test_keyword_order_and_empty_results(spark):
    find = lambda c: clean.first_keyword(c, rules.CONDITION_KEYWORDS)
    assert values(spark, find, ["Ewing Sarcoma", "Leukemia, NOS", "Acute Myeloid Leukemia", "odd"]) == ["Sarcoma, NOS", None, "Acute Myeloid Leukemia", None]
    assert values(spark, lambda c: clean.first_keyword(c, rules.CONDITION_KEYWORDS, "longest"), ["Ewing Sarcoma"]) == ["Ewing Sarcoma"]


def test_validate_splits_rows(spark):
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("2", None)], "id string, source string")
    good, bad = clean.validate(rows, {"id": "long", "source": "string"})
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert sorted(r["reason"][0] for r in bad.collect()) == ["id missing", "id not long", "source missing"]


def test_raw_columns_survive(spark):
    rows = spark.createDataFrame([(1, "x", None)], "id int, raw_new string, raw_none string")
    assert clean.collect_raw_map(rows).head()["raw"] == {"raw_new": "x"}
    assert clean.collect_raw_map(rows.select("id")).head()["raw"] == {}
