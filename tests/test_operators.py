import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from trialframe.functions import rules
from trialframe.operators import annotate, coverage, curate, lifecycle, matches, nodes, patients, trials, vocab

TRIALS = "entity string, protocol_no string, nct_id string, eligibility string, tree string, status string, ord int"


def test_weekly_cycle_routes_and_carries(spark):
    master = spark.createDataFrame([("a", "e1", "curated", "old", 0), ("b", "e2", "t", "s", 1), ("c", "e3", "t", "s", 2), ("a", "e1", "curated2", "old", 3)], "key string, e string, tree string, status string, ord int")
    new = spark.createDataFrame([("a", "e1", "fresh", "new", 0), ("b", "E2", "fresh", "s", 1), ("d", "e4", "fresh", "s", 2)], master.schema)
    routed = {r.key: (r.route, r.tree, r.status) for r in lifecycle.route_snapshot(new, master, "key", F.col("e"), ["tree"], ord="ord").collect()}
    assert routed == {"a": ("unchanged", "curated2", "new"), "b": ("changed", "fresh", "s"), "d": ("changed", "fresh", "s"), "c": ("deleted", "t", "s")}
    none = master.limit(0)
    assert {r.route for r in lifecycle.snapshot_diff(new, none, "key", F.col("e")).collect()} == {"changed"}
    merged = lifecycle.merge_master(new, new.limit(1))
    assert [r.n for r in lifecycle.duplicate_keys(merged, "key").collect()] == [2]


def test_null_eligibility_equals_null(spark):
    rows = spark.createDataFrame([("a", None)], "key string, e string")
    assert lifecycle.snapshot_diff(rows, rows, "key", F.col("e")).head()["route"] == "unchanged"


MATCH = "sample_id string, protocol_no string, nct_id string, match_level string, reason_type string, match_type string, cancer_type_match string, code string, show_in_ui boolean, sort_order array<int>, genomic_alteration string, trial_summary_status string, true_hugo_symbol string, true_protein_change string, true_cdna_change string, variant_category string, ord int"


def match(sample, protocol, reason, order, ord, level="step", show=True):
    return (sample, protocol, "N" + (protocol or ""), level, reason, "t", "c", None, show, order, None, "OPEN to", "G", None, "", "MUTATION", ord)


def test_report_context(spark):
    rows = [
        match("8", "p1", "clinical", [1] * 6, 0),
        match("8", "p2", "clinical", [1] * 6, 1),
        match("8", "p1", "genomic", [5] * 6, 2),
        match("8", "p3", "clinical", None, 3),
        match("8", "p2", "clinical", [1] * 6, 4),
        match("8", "p4", "genomic", [0] * 6, 5, show=False),
        match("8", "", "clinical", [0] * 6, 6),
        match("9", "p1", "clinical", [3] * 6, 7),
        match("9", "p2", "genomic", None, 8, level="step"),
        match("9", "p3", "clinical", None, 9, level="arm"),
    ]
    df = spark.createDataFrame(rows, MATCH)
    trials = spark.createDataFrame([("p1", ("long", None, "Phase I", ("Dr",)))], "protocol_no string, _summary struct<long_title:string,short_title:string,phase:string,investigator:struct<full_name:string>>")
    extras = spark.createDataFrame([("8", ("Ann", ["liver", "lung"]), ["r"])], "sample_id string, patient struct<first_name:string,metastasis_sites:array<string>>, reports array<string>")
    out = {r.sample_id: r for r in matches.report_context(df, trials, extras).collect()}
    eight = out["8"]
    assert {x.label: x.value for x in eight.primary_match.trial} == {
        "Trial Name": "long", "NCT ID": "Np1", "Protocol No.": "p1", "Phase": "Phase I", "Investigator": "Dr", "Match Level": "step", "Trial Status": "Open to", "Match Engine": rules.MATCH_ENGINE,
    }
    assert [x.label for x in eight.primary_match.genomic] == ["Gene", "Variant Category"]
    assert [x.protocol_no for x in eight.other_matches] == ["p2", "p3"]
    assert [x.value for x in eight.patient_detail] == ["liver, lung"]
    assert out["9"].primary_match.nct_id == "Np3" and out["9"].patient_header is None


def exchanges(df):
    """Of a plan that hasn't run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(sample_id")


def test_report_shuffles_matches_once(spark):
    rows = [match("1", "p1", "genomic", None, 0), match("1", "p2", "clinical", None, 1), match(None, "p1", "genomic", None, 2), match(None, "p2", "clinical", None, 3)]
    trials = spark.createDataFrame([], "protocol_no string, _summary struct<long_title:string,short_title:string,phase:string,investigator:struct<full_name:string>>")
    extras = spark.createDataFrame([("2", ("Ann",), ["r"])], "sample_id string, patient struct<first_name:string>, reports array<string>")
    report = matches.report_context(spark.createDataFrame(rows, MATCH), trials, extras)
    out = {r.sample_id: r.other_matches and [(x.number, x.protocol_no) for x in r.other_matches] for r in report.collect()}
    assert out == {"1": [(1, "p2")], "2": None, None: None}
    assert exchanges(report) <= 3  # matches, patients, and both after a large join with trials


def test_other_matches_shuffle_once(spark):
    rows = [match("1", "p2", "clinical", None, 4), match("1", "p3", "clinical", None, 3), match("1", "p2", "clinical", None, 2), match("1", "p1", "genomic", None, 1), match("1", None, "clinical", None, 0), match("2", None, "genomic", None, 0), match("2", "p1", "clinical", None, 1)]
    others = matches.other_matches(spark.createDataFrame(rows, MATCH), "sample_id", "protocol_no", matches.match_priority(), ["ord"])
    assert sorted((r.sample_id, r.number, r.protocol_no, r.ord) for r in others.collect()) == [("1", 1, "p2", 2), ("1", 2, "p3", 3), ("2", 1, "p1", 1)]
    assert exchanges(others) == 1


def test_other_matches_sort_twice(spark):
    values = ((s, p, r, o) for s in ("1", "2", None) for p in ("p1", "p2", "p3", "", None) for r in ("genomic", "clinical") for o in ([1] * 6, [2] * 6, None))
    rows = [match(s, p, r, o, (i * 37) % 90) for i, (s, p, r, o) in enumerate(values)]
    others = matches.other_matches(spark.createDataFrame(rows, MATCH), "sample_id", "protocol_no", matches.match_priority(), ["ord"])
    expected = []
    for sample in ("1", "2"):
        own = sorted((r for r in rows if r[0] == sample), key=lambda r: r[-1])
        primary = min(own, key=lambda r: (r[4] != "genomic", r[9] or matches.DEFAULT_ORDER, r[-1]))
        first = {r[1]: r for r in reversed(own) if r[1] and r[1] != primary[1]}
        expected += [(sample, i, r[1], r[-1]) for i, r in enumerate(sorted(first.values(), key=lambda r: r[-1]), 1)]
    assert sorted((r.sample_id, r.number, r.protocol_no, r.ord) for r in others.collect()) == expected
    assert others.select("*")._jdf.queryExecution().executedPlan().toString().count("Sort [") == 2  # a third one held the ranks


def test_no_matches(spark):
    empty = spark.createDataFrame([], MATCH)
    assert matches.primary_match(empty, "sample_id", matches.match_priority(), ["ord"]).count() == 0


def test_coverage(spark):
    rows = [("a", "1", "x"), ("a", "2", "x"), ("b", "1", "y"), ("b", None, "y"), ("c", None, "x")]
    df = spark.createDataFrame(rows, "source string, id string, status string")
    assert {(r.a, r.b): r.n for r in coverage.overlap_matrix(df, "source", "id").collect() if r.n} == {("a", "a"): 2, ("a", "b"): 1, ("b", "a"): 1, ("b", "b"): 1}
    assert {r.source: r.n for r in coverage.exclusive_ids(df, "source", "id").collect()} == {"a": 1, "b": 0, "c": 0}
    assert [tuple(r) for r in coverage.conflicts(df, "id", "source", "status", ["a", "b", "c"]).collect()] == [("1", "x", "y", "—")]
    step = "array<struct<match:array<string>>>"
    trees = [['{"clinical":{"age_numerical":">=18"}}'], ['{"clinical":{"gender":"Male"}}'], ["a", "b"], ['{"genomic":{"g":1}}'], []]
    flags = spark.createDataFrame([([(t,)],) for t in trees], f"s {step}").select(coverage.match_beyond_age("s")).collect()
    assert [r[0] for r in flags] == [False, True, True, True, False]


def test_flags_and_source_map(spark):
    rows = [(["a"], None, [("d",)]), ([], ["b"], []), (None, None, None), ([], [], [])]
    df = spark.createDataFrame([(i, e, (d,)) for i, e, d in rows], "i array<string>, e array<string>, _summary struct<drugs:array<struct<name:string>>>")
    assert [tuple(r) for r in df.select(coverage.has_eligibility("i", "e"), coverage.has_drugs()).collect()] == [(True, True), (True, False), (False, False), (False, False)]
    trials = spark.createDataFrame([("n1", "amc", "old", 0), ("n1", "amc", "new", 1), ("n1", "ctgov", "c", 0), (None, "amc", "x", 2)], "nct_id string, source string, title string, ord int")
    found = coverage.source_map(trials, "nct_id", "source", "ord").collect()
    assert [(r.nct_id, {k: v.title for k, v in r.by_source.items()}) for r in found] == [("n1", {"amc": "new", "ctgov": "c"})]


def test_selected_trials(spark):
    df = spark.createDataFrame([("c", 2), ("a", 0), ("b", 1)], "trial_key string, ord int")
    names = lambda *a: [r.trial_key for r in trials.selected(df, *a).collect()]
    assert names(None, 2) == ["a", "b"] and sorted(names(["a", "c"], 1)) == ["a", "c"] and len(names()) == 3 and names([], 1) == ["a"]


def test_category_cascade_stops_at_rules_without_value(spark):
    rows = [(1, [("Childhood Cancers", "Solid Tumor", "Germ Cell"), ("Breast", "unknown", "x"), ("Breast", "", ""), ("None such", "", "")])]
    df = spark.createDataFrame(rows, "trial_key int, categories array<struct<cat1:string,cat2:string,cat3:string>>")
    assert vocab.category_diagnoses(df, spark).head()["diagnoses"] == ["Breast"]


def test_condition_keywords(spark):
    df = spark.createDataFrame([(["Ewing Sarcoma", "Lymphoma", "breast", "Breast Cancer"],)], "c array<string>")
    assert df.select(vocab.condition_diagnoses(F.col("c"))).head()[0] == ["Sarcoma, NOS", "Breast"]


def test_a_bucketed_master_is_not_exchanged(spark):
    import uuid

    rows = [(i % 40, f"v{i % 7}", i) for i in range(100)]
    master = spark.createDataFrame(rows, "key int, value string, ord int")
    new = spark.createDataFrame([(i, f"v{i % 5}", 0) for i in range(30, 60)] + [(None, "x", 0)], master.schema)
    name = f"master_{uuid.uuid4().hex}"
    kept = lifecycle.save_master(master, name, "key", 4)
    try:
        diff = lifecycle.snapshot_diff(new, kept, "key", F.md5("value"), ord="ord")
        plain = lifecycle.snapshot_diff(new, master, "key", F.md5("value"), ord="ord")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert sorted(map(tuple, diff.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        plan = lifecycle.snapshot_diff(new, kept, "key", F.md5("value"), ord="ord")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_keyword_rules(spark):
    """The table form against the chain on the library's own rules, and against a search of all of 10,000 rules."""
    import random

    from trialframe.functions import clean

    def table(listed):
        return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(listed)], "pos int, keyword string, value string")

    rng = random.Random(2)
    own = list(rules.CONDITION_KEYWORDS)
    texts = [None, "", "nothing here", *(f"{rng.choice(own)[0].upper()} x {rng.choice(own)[0]}" for _ in range(200))]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, value string")
    chain = df.select("i", clean.first_keyword(F.col("text"), own).alias("value")).collect()
    got = vocab.keyword_rules(df, "text", table(own))
    assert got.columns == ["i", "text", "value"]
    assert {r.i: r.value for r in got.collect()} == {r.i: r.value for r in chain}

    many = [("".join(rng.choices("abcdé", k=rng.randint(4, 7))), rng.choice((None, f"v{i}"))) for i in range(10_000)] + [("", "never"), (None, "never")]
    texts = ["".join(rng.choices("abcdé ", k=rng.randint(0, 60))) for _ in range(200)] + ["e" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = {i: next((v for k, v in many if k and k in t), None) for i, t in enumerate(texts)}
    assert {r.i: r.value for r in vocab.keyword_rules(df, "text", table(many)).collect()} == want
    assert {r.value for r in vocab.keyword_rules(df, "text", table([])).collect()} == {None}
    assert vocab.keyword_rules(df.limit(0), "text", table(own)).count() == 0


def test_vocabulary(spark):
    names = spark.createDataFrame([(x,) for x in ("Diffuse Glioma", "!Glioma", "Leukemia", "Melanomma", "!Melanomma", "zzz", None)], "name string")
    known = spark.createDataFrame([("Diffuse Glioma",), ("Melanoma",)], "name string")
    found = {r.name: r.resolved for r in vocab.resolve(names, known).collect()}
    assert found == {"Diffuse Glioma": "Diffuse Glioma", "!Glioma": "!Diffuse Glioma", "Leukemia": None, "Melanomma": "Melanoma", "!Melanomma": "!Melanoma", "zzz": None, None: None}


def test_fuzzy_agrees_with_difflib(spark):
    import difflib
    import random

    rng = random.Random(4)
    known = ["".join(rng.choice("abcd") for _ in range(rng.randrange(3, 12))) for _ in range(60)]
    names = [w[:k] + rng.choice("abcde") + w[k + 1 :] for w in known for k in (1, len(w) - 1)]
    found = vocab.closest(spark.createDataFrame([(n,) for n in set(names)], "name string"), spark.createDataFrame([(n,) for n in set(known)], "name string"))
    got = {r.name: r.ratio for r in found.collect()}
    for name in set(names):
        best = difflib.get_close_matches(name, known, n=1, cutoff=0.85)
        ratio = difflib.SequenceMatcher(None, best[0], name).ratio() if best else None
        assert got.get(name) == ratio, name


@pytest.mark.parametrize(("cutoff", "letters"), [(0.85, "abcdefghij "), (0.75, "ab"), (0.6, "abc"), (1.0, "ab")])
def test_fuzzy_join_loses_no_pair(spark, cutoff, letters):
    """Names of 1 to 30 letters, many of them alike, against the ratio of all pairs."""
    import difflib
    import random

    rng = random.Random(len(letters))
    known = ["".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 3, 4, 6, 9, 14, 30)))) for _ in range(80)]
    names = ["", "é", "日本語"]
    for w in known:
        for _ in range(2):
            k = rng.randrange(len(w) + 1)
            names.append(rng.choice((w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[k:] + w[:k], w)))
    best = {}
    for name in {x for x in names if x}:
        found = [(difflib.SequenceMatcher(None, w, name).ratio(), w) for w in set(known)]
        if max(found)[0] >= cutoff:
            best[name] = max(found)[::-1]
    got = vocab.closest(spark.createDataFrame([(n,) for n in [*names, None]], "name string"), spark.createDataFrame([(n,) for n in [*known, *known, None, ""]], "name string"), cutoff)
    assert {r.name: (r.match, r.ratio) for r in got.collect()} == best


def test_nodes(spark):
    leaf = lambda d: {"clinical": {"oncotree_primary_diagnosis": d}}
    trees = {
        1: {"and": [leaf("A"), {"or": [leaf("Typo"), {"genomic": {"x": 1}}]}]},
        2: {"or": [leaf("Gone"), leaf("Gone")]},
        3: {"clinical": {"oncotree_primary_diagnosis": "Gone", "gender": "Male"}, "genomic": {"x": 1}},
        4: {"genomic": {"x": 1}},
        5: None,
    }
    df = spark.createDataFrame([(k, json.dumps(t) if t else None) for k, t in trees.items()], "k int, node string")
    valid = spark.createDataFrame([("A",), ("B",)], "name string")
    out = {r.k: json.loads(r.node) if r.node else None for r in nodes.validate_nodes(df, valid, "k", "node", {"Typo": "B", "Gone": None}).collect()}
    assert out == {1: {"and": [leaf("A"), {"or": [leaf("B"), {"genomic": {"x": 1}}]}]}, 2: None, 3: {"clinical": {"gender": "Male"}}, 4: {"genomic": {"x": 1}}}
    flat = nodes.flatten_nodes(df, "k", "node")
    assert {r.k: r.has_diagnosis for r in nodes.has_diagnosis(flat, "k").collect()} == {1: True, 2: True, 3: True, 4: False}
    made = spark.createDataFrame([([],), (["A"],), (["A", "B"],)], "d array<string>").select(nodes.diagnoses_to_node(F.col("d"))).collect()
    assert [json.loads(r[0]) if r[0] else None for r in made] == [None, leaf("A"), {"or": [leaf("A"), leaf("B")]}]
    steps = spark.createDataFrame([([(["x"],), (["y"],)],)], "s array<struct<match:array<string>>>")
    assert [r.match for r in steps.select(nodes.append_node(F.col("s"), F.lit("n"))).head()[0]] == [["x", "n"], ["y"]]


def nested_tree(depth, leaf):
    """A chain of and/or around a leaf, each with a genomic sibling."""
    node = leaf
    for k in range(depth):
        node = {("and", "or")[k % 2]: [node, {"genomic": {"level": k}}]}
    return node


@pytest.mark.parametrize("depth", [5, 40])
def test_trees_of_any_depth(spark, depth):
    leaf = lambda d: {"clinical": {"oncotree_primary_diagnosis": d}}

    def recursive(node):
        for op in ("and", "or"):
            if op in node:
                own = [x for x in map(recursive, node[op]) if x is not None]
                return {op: own} if own else None
        if "clinical" in node:
            name = {"A": "A", "Typo": "B"}.get(node["clinical"]["oncotree_primary_diagnosis"])
            return leaf(name) if name else None
        return node

    chain = leaf("Gone")
    for _ in range(depth):
        chain = {"and": [chain]}
    trees = [nested_tree(depth, leaf("Typo")), nested_tree(depth, leaf("Gone")), chain, {"or": [chain, nested_tree(depth, leaf("A"))]}]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)] + [(None, json.dumps(trees[0])), (9, "not json"), (10, "[1]")], "k int, node string")
    valid = spark.createDataFrame([("A",), ("B",)], "name string")
    out = {r.k: json.loads(r.node) if r.node else None for r in nodes.validate_nodes(df, valid, "k", "node", {"Typo": "B", "Gone": None}).collect()}
    assert out == {i: recursive(t) for i, t in enumerate(trees)} | {None: recursive(trees[0]), 9: None, 10: None}
    flat = nodes.flatten_nodes(df, "k", "node").filter("k = 0")
    assert flat.count() == 2 * depth + 1 and flat.agg(F.max(F.size("node_path"))).head()[0] == depth
    assert all(r.has_diagnosis for r in nodes.has_diagnosis(flat, "k").collect())


def test_odd_trees(spark):
    """Names that are no text, children that are no objects, odd spacing and numbers, keys in any order, deep nesting."""
    name = "oncotree_primary_diagnosis"
    trees = [
        f'{{"clinical": {{"b": 1.50, "{name}": ["A"], "a": {{"z": 1, "y": [1, 2]}}}}}}',
        f'{{"clinical": {{"{name}": ["A"]}}}}',
        f'{{ "or" : [ 5, "text", null, [1], {{"clinical": {{"{name}": "A", "note": "he said \\"[[["}} }} ] , "and": null}}',
        '{"and": {"x": 1}}',
        '{"and": []}',
        '{"genomic": {"x": "]]\\\\"}, "clinical": null}',
        "{}",
        "",
        "{",
        '"{}"',
        '{"and":[' * 30 + '{"genomic":{}}' + "]}" * 30,
        '{"and":[' * 5000 + '{"genomic":{}}' + "]}" * 5000,
        None,
    ]
    df = spark.createDataFrame(list(enumerate(trees)), "k int, t string")
    valid = spark.createDataFrame([("A",)], "name string")
    out = {r.k: r.node for r in nodes.validate_nodes(df, valid, "k", "t", {}, levels=6).collect()}
    assert out == {
        0: '{"clinical":{"b":1.5,"a":{"y":[1,2],"z":1}}}',
        1: None,
        2: f'{{"or":[{{"clinical":{{"{name}":"A","note":"he said \\"[[["}}}}]}}',
        3: None,
        4: None,
        5: '{"genomic":{"x":"]]\\\\"},"clinical":null}',
        6: "{}",
        **dict.fromkeys((7, 8, 9, 10, 11)),
    }
    assert {r.k: r.reason for r in nodes.rejects(df, "k", "t", levels=6).collect()} == {0: "a name that is no text", 1: "a name that is no text", **dict.fromkeys((7, 8, 9, 11), "no JSON object"), 10: "over 6 levels"}
    flat = sorted((r.k, list(r.node_path), r.op) for r in nodes.flatten_nodes(df, "k", "t", levels=6).collect())
    assert flat == [(0, [], "clinical"), (1, [], "clinical"), (2, [], "or"), (2, [4], "clinical"), (3, [], "and"), (4, [], "and"), (5, [], "genomic"), (6, [], "genomic")]
    empty = df.limit(0)
    assert nodes.validate_nodes(empty, valid, "k", "t").count() == nodes.rejects(empty, "k", "t").count() == 0


def test_equal_trees_are_validated_once(spark, monkeypatch):
    sizes, stored = {}, nodes.stored

    def counted(df, tag):
        out = stored(df, tag)
        sizes[tag] = out.count()
        return out

    monkeypatch.setattr(nodes, "stored", counted)
    text = '{"clinical":{"oncotree_primary_diagnosis":"%s"}}'
    rows = [(k % 7, text % "AT"[k % 2]) for k in range(20)] + [(None, text % "A"), (8, "no tree"), (9, None)]
    valid = spark.createDataFrame([("A",), ("B",)], "name string")
    out = nodes.validate_nodes(spark.createDataFrame(rows, "k int, node string"), valid, "k", "node", {"T": "B"}).collect()
    assert sorted(map(str, out)) == sorted(str(Row(k=k, node=None if t == "no tree" else t.replace('"T"', '"B"'))) for k, t in rows if t)
    assert sizes["trees"] == 22 and sizes["levels"] == sizes["texts"] == 3


def test_store_nulls_are_hits(spark):
    work = spark.createDataFrame([(1, "k1", "t1"), (1, "k2", "t2"), (2, "k3", "t3"), (2, "k3", "t3")], "trial int, cache_key string, text string")
    store = spark.createDataFrame([("k1", None, True, 0), ("k2", '"a"', False, 0), ("k2", '"b"', False, 1)], annotate.STORE_SCHEMA)
    found = annotate.look_up(work, store)
    assert {(r.cache_key, r.value_json, r.hit) for r in found.collect()} == {("k1", None, True), ("k2", '"b"', True), ("k3", None, False)}
    assert {r.trial: (r.n_items, r.n_cached) for r in annotate.progress(found, "trial").collect()} == {1: (2, 2), 2: (2, 0)}
    more = annotate.annotate(annotate.misses(work, store), lambda s: s.where(s != "t3"), ord=5).collect()
    assert [tuple(r) for r in more] == [("k3", None, True, 5)]
    kb = spark.createDataFrame([("brca1",)], "name string")
    rows = spark.createDataFrame([("BRCA1",), ("x",), (None,)], "biomarker string")
    assert [r.in_kb for r in annotate.flag_known(rows, "biomarker", kb).orderBy(F.desc("in_kb")).collect()] == [True, False, False]


def test_tiers(spark):
    rows = [(1, True, ["ihc", "snv"]), (2, True, ["ihc"]), (3, True, None), (4, False, []), (5, None, [])]
    df = spark.createDataFrame(rows, "k int, d boolean, t array<string>")
    out = {r.k: r.tier for r in curate.split_by_confidence(df, F.col("d"), F.col("t"), ["ihc", "other"]).collect()}
    assert out == {1: "needs_curation", 2: "high_confidence", 3: "high_confidence", 4: "needs_curation", 5: "needs_curation"}


def test_recovered_diagnoses(spark):
    trials = spark.createDataFrame([(1, "N1", "title", "sum"), (2, "N2", None, " ")], "k int, id string, t string, s string")
    work = curate.recovery_worklist(trials, "k", "id", "t", "s")
    assert work.count() == 1
    store = work.select("cache_key", F.lit('["_SOLID_", "Glioma", "Leukemia", "Glioma"]').alias("value_json"), F.lit(False).alias("is_null"), F.lit(0).cast("long").alias("ord"))
    known = spark.createDataFrame([("Diffuse Glioma",)], "name string")
    assert curate.recovered_diagnoses(work, store, known, "k").head()["diagnoses"] == ["_SOLID_", "Diffuse Glioma"]


def test_pairs_without_a_left_part(spark):
    """Rows without a gene's name are left out, however the name comes about."""
    genes = ["::B", " ::B", "A::B", "/B", "/B::C", "A/B", "-B", "-B/C", "-B::C", "A-B", "-", "A-", "A", " ", "", None, "/\n::B", "-\nB/C"]
    people = spark.createDataFrame([(1, "m")], "pt_uuid long, mrn string")
    none = F.lit(None).cast("string")
    rows = spark.createDataFrame([(1, g, t) for g in genes for t in ("fusion", "SNV")], "pt_uuid long, gene string, variant_type string")
    genomic, _ = patients.genomic_rows(people, rows.withColumns({"protein": none, "nucleotide": none, "result_summary": none}))
    expected = []
    for g in genes:
        sep = next((x for x in ("::", "/", "-") if x in (g or "")), None)
        left = g.split(sep, 1)[0].strip() if sep else g
        expected += [x for x in (left, g) if x]
    assert sorted(r.TRUE_HUGO_SYMBOL for r in genomic.collect()) == sorted(expected)


def test_genomic_rows(spark):
    people = spark.createDataFrame([(1, "m1"), (2, "")], "pt_uuid long, mrn string")
    fields = "pt_uuid long, report_uuid long, gene string, protein string, nucleotide string, variant_type string, result_summary string"
    rows = [
        (1, 1, "PML/RARA", None, None, "fusion", None),
        (1, 1, "EGFR", "NA", "c.1", " SNV ", None),
        (1, 1, "ERBB2", None, None, "amplification", ""),
        (1, 1, "TMB", None, None, "tumor_biomarker", "4.1"),
        (1, 1, "MSI", None, None, "tumor biomarker", "MSI-H"),
        (2, 2, "KRAS", None, None, "negative", None),
        (2, 2, "", None, None, "SNV", None),
        (2, 2, "X", None, None, "hla", None),
        (2, 2, "X", None, None, "snv", None),
    ]
    genomic, rejects = patients.genomic_rows(people, spark.createDataFrame(rows, fields))
    got = {(r.SAMPLE_ID, r.TRUE_HUGO_SYMBOL): r for r in genomic.collect()}
    assert set(got) == {("m1", "PML"), ("m1", "EGFR"), ("m1", "ERBB2"), ("m1", "MSI"), ("2", "KRAS")}
    assert got["m1", "PML"].RIGHT_PARTNER_GENE == "RARA" and got["m1", "EGFR"].TRUE_PROTEIN_CHANGE is None
    assert got["m1", "ERBB2"].CNV_CALL == "High level amplification" and got["m1", "MSI"].MMR_STATUS == rules.MMR_LABELS[0]
    assert got["2", "KRAS"].WILDTYPE is True
    assert patients.unknown_types(rejects).head()[0] == ["snv"]
