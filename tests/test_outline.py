import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trialframe.operators import outline


def stack_parse(text, tilde):
    """(pos, parent) pairs by an explicit table of the last item of each depth."""
    out, section, last = [], None, {}
    for pos, line in enumerate(text.split("||") if tilde else re.split(r"\r\n|\n|\r", text)):
        low = line.strip().lower()
        if re.match(r"(inclusion|exclusion) criteria\s*:?" + (r"\s*$" if tilde else ""), low):
            section, last = low[:9], {}
            continue
        if section is None:
            continue
        if tilde:
            body = line.strip()
            depth = len(body) - len(body.lstrip("~"))
            body = re.sub(r"^(inclusion|exclusion) criteria\s*:\s*", "", body.lstrip("~").strip(), flags=re.I)
        else:
            depth = (len(line) - len(line.lstrip())) // 2 + 1
            body = re.sub(r"^\*+\s*", "", line.strip()).strip()
        if not body:
            continue
        out.append((pos, last.get(depth - 1) if depth >= 2 else None, section, body))
        last[depth] = pos
    return out


item = st.tuples(st.integers(0, 4), st.sampled_from(["a", "b c", "Inclusion Criteria: d", "", "Inclusion Criteria:", "Exclusion criteria"]))
head = st.sampled_from(["Inclusion Criteria", "exclusion criteria :", "Inclusion Criteria: more"])


def lines(outlines, mark):
    return [[mark(d, t) if not isinstance(x, str) else x for x in o for d, t in [x if not isinstance(x, str) else (0, x)]] for o in outlines]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(item, head), max_size=25), min_size=20, max_size=40))
def test_parents_agree_with_a_stack_parser(spark, outlines):
    tilde = ["||".join(x) for x in lines(outlines, lambda d, t: "~" * d + t)]
    markdown = ["\n".join(x) for x in lines(outlines, lambda d, t: "  " * d + "* " + t)]
    for texts, parse, is_tilde in ((tilde, outline.parse_outline_tilde, True), (markdown, outline.parse_outline_markdown, False)):
        df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
        found = sorted((r.k, r.pos, r.parent_pos, r.source, r.text) for r in parse(df, "k", "text").collect())
        assert found == sorted((k, *x) for k, text in enumerate(texts) for x in stack_parse(text, is_tilde))


def test_stale_parent_and_missing_parent(spark):
    df = spark.createDataFrame([(1, "Inclusion Criteria||~A||~~B||~C||~~~D"), (2, "Inclusion Criteria||~~B")], "k int, text string")
    found = {(r.k, r.text): r.parent_pos for r in outline.parse_outline_tilde(df, "k", "text").collect()}
    assert found == {(1, "A"): None, (1, "B"): 1, (1, "C"): None, (1, "D"): 2, (2, "B"): None}


def test_worklist_and_full_text(spark):
    text = "Exclusion Criteria||~X||Inclusion Criteria||~A||~~B||~~~C||~~D||~E"
    criteria = outline.parse_outline_tilde(spark.createDataFrame([(1, text)], "k int, text string"), "k", "text")
    work = outline.criteria_worklist(criteria, "k")
    assert [(r.source, r.text) for r in work.orderBy("nth").collect()] == [("inclusion", "A\n  B\n    C\n  D"), ("inclusion", "E"), ("exclusion", "X")]
    assert outline.full_text(work, "k").head()["text"] == "A\n  B\n    C\n  D\nE\nX"


@pytest.mark.parametrize("depth", [9, 200])
def test_outlines_of_any_depth(spark, depth):
    text = "||".join(["Inclusion Criteria", *["~" * (i + 1) + f"t{i}" for i in range(depth)], "~other", "~~below"])
    criteria = outline.parse_outline_tilde(spark.createDataFrame([(1, text), (2, text)], "k int, text string"), "k", "text")
    work = [r.text for r in outline.criteria_worklist(criteria, "k").orderBy("k", "nth").collect()]
    assert work == ["\n".join("  " * i + f"t{i}" for i in range(depth)), "other\n  below"] * 2
    assert {len(r.path) for r in outline.criterion_paths(criteria, "k").collect()} == set(range(1, depth + 1))


def test_odd_links(spark):
    """Null keys, parents that aren't there, come later or are the item itself, repeated positions, clashing columns."""
    rows = [(None, 0, None), (None, 1, 0), (1, 0, 5), (1, 1, 1), (1, 2, 3), (1, 3, 2), (2, 0, None), (2, 1, 0), (2, 1, 0), (2, 2, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k int, pos int, parent_pos int, path string")
    got = sorted(((r.k, r.pos, list(r.path), r.root_pos) for r in outline.criterion_paths(df, "k").collect()), key=repr)
    want = [(None, 0, [0], 0), (None, 1, [0, 1], 0), (1, 0, [0], 0), (1, 1, [1], 1), (1, 2, [2], 2), (1, 3, [2, 3], 2), (2, 0, [0], 0), (2, 1, [0, 1], 0), (2, 1, [0, 1], 0), (2, 2, [0, 1, 2], 0)]
    assert got == sorted(want, key=repr)
    assert outline.criterion_paths(df.limit(0), "k").count() == 0


def test_null_and_empty_outlines(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "~A")], "k int, text string")
    assert outline.parse_outline_tilde(df, "k", "text").count() == 0
    assert outline.parse_outline_markdown(df, "k", "text").count() == 0
