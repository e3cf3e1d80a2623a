"""License notices against a brute-force comparison of all blocks, and odd tables."""

import random
import re

import pytest

from trialframe.llm import license_scan as L

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def base(words):
    places = [(i, k) for k, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for _, k in places}))


def blocks(words, templates):
    """(template, block start, shared) of all blocks that match, consecutive or not."""
    for t in templates:
        own = set(t.words)
        for b in range(0, len(words), t.stride):
            shared = len(own & set(words[b : b + 2 * t.stride]))
            if own and shared >= t.need:
                yield t, b, shared / len(own)


def method(words, templates):
    labels, score = set(), 0.0
    for t, b, containment in blocks(words, templates):
        if not t.consecutive or any(words[i : i + len(t.words)] == t.words for i in range(b, b + t.stride)):
            labels.add(t.label)
            score = max(score, containment)
    return ",".join(sorted(labels)), score


def test_notices_and_odd_texts(spark, odd_docs):
    notices = [t.text for t in L.TEMPLATES]
    half = " ".join(notices[9].split()[::2])
    texts = [*notices, *(" word" * 37 + " " + n.upper() + " tail" * 50 for n in notices), "CC\n-BY by cc; cc by cc by", "cc_by ccby cc by2 by", half, "General Public License " * 40, "KA ALL rights\x00reserved É"]
    docs = odd_docs.select("doc_id", "text", "n_tokens").union(spark.createDataFrame([(1000 + i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int"))
    found = sorted((tuple(r) for r in L.digest(docs).collect()), key=repr)
    want = []
    for r in docs.collect():
        n, places, first, last, names = base(split(r.text))
        want.append((r.doc_id, n, places, first, last, names, *method(split(r.text), L.TEMPLATES)))
    assert found == sorted(want, key=repr)
    of = {r[0]: r for r in found}
    assert all(set(t.label.split(",")) <= set(of[1000 + i][6].split(",")) and of[1000 + i][7] == 1.0 for i, t in enumerate(L.TEMPLATES))
    assert "mit" not in of[1000 + 2 * len(notices) + 2][6]


@pytest.mark.parametrize("seed", range(3))
def test_random_sets(spark, seed):
    rng = random.Random(seed)
    words = ["ab", "c1", "été", "d", "ee", "f", "g", "h"] + [f"w{i}" for i in range(8)]
    templates = tuple(L.Template(f"t{i}", " ".join(rng.choices(words, k=rng.randint(1, 40))), rng.choice((0.3, 0.6, 0.8, 1.0)), i % 5 == 0) for i in range(12))
    texts = [" ".join(rng.choices(words + ["other"] * rng.randint(0, 40), k=rng.randint(0, 200))) for _ in range(60)]
    found = {r.doc_id: (r.labels, round(r.score, 9)) for r in L.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates).collect()}
    assert found == {i: (x[0], round(x[1], 9)) for i, t in enumerate(texts) for x in [method(split(t), templates)]}


def test_spans(spark):
    text = "one two " + L.TEMPLATES[12].text + " three"
    _, found = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    rows = found.filter("label = 'bsd'").collect()
    assert min(r.start for r in rows) == 2 and max(r.end for r in rows) == 2 + len(split(L.TEMPLATES[12].text))


def test_no_rows_and_no_templates(spark, no_docs, odd_docs):
    assert L.digest(no_docs).collect() == []
    assert {r.labels for r in L.digest(odd_docs, ()).collect()} == {""}
    with pytest.raises(ValueError):
        L.scan(odd_docs, (L.Template("x", "a " * (L.MAX_WORDS + 1)),))


def test_no_python_in_the_plan(spark, odd_docs):
    plan = L.digest(odd_docs.select("doc_id", "text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
