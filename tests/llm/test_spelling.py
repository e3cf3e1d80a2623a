"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from trialframe.llm import queries
from trialframe.llm import spelling as S

from .conftest import SF


def one_edit(a, b):
    """By trying all single edits of the longer word."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def counted(rows):
    found, low = Counter(), str.maketrans(S.UPPER, S.LOWER)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def answer(words, times=5):
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def rows_of(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_is_brute_force(spark, docs):
    words = counted((r.doc_id, r.text) for r in docs.collect())
    assert rows_of(queries.op12_spelling(spark, SF)) == answer(words)


@pytest.mark.parametrize(("groups", "shard"), [(12, 20_000), (3, 1), (5, 40)])
def test_dense_words(spark, groups, shard):
    rng = random.Random(groups)
    letters = "abé"
    words = {"".join(rng.choices(letters, k=rng.randint(1, 6))): rng.choice((5, 6, 30, 200, 2000)) for _ in range(500)}
    words |= {w: 7 for w in ("x" * 60, "x" * 61, "x" * 47 + "y", "x" * 48, "x" * 49, "x" * 30 + "y" + "x" * 30, "a" * 3000, "a" * 1500 + "b" + "a" * 1500)}
    words |= {"".join(p): 9 for p in {tuple(rng.sample("abcdefg", 7)) for _ in range(200)}}  # one vector
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(S.variants(df, groups=groups, shard_words=shard)) == answer(words)


def test_chains_and_ties(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 5, "yzzzzz": 50, "xzzzzz": 50, "qqqqqq": 9}
    got = {r[0]: r for r in rows_of(S.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert got["aaaaaa"][1:3] == ("aaaaab", "aaabbb") and got["zzzzzz"][1:3] == ("xzzzzz", "xzzzzz") and got["qqqqqq"][1:5] == (None, "qqqqqq", 9, 0)


def test_odd_texts(spark, odd_docs, no_docs):
    more = [(None, "Wörter×÷ wörter×÷ WöRter×÷ wörter×÷ wörter×÷ wörter×÷"), (7, "Éclairs éclairs " * 5), (None, None), (8, "日本語abcdefg " * 9 + "abcdef_" * 5), (9, "k" * 5000 + " " + ("k" * 4999 + " ") * 6)]
    docs = odd_docs.select("doc_id", "text", "n_tokens").union(spark.createDataFrame([(i, t, 0) for i, t in more], "doc_id long, text string, n_tokens int"))
    words = counted((r.doc_id, r.text) for r in docs.collect())
    assert len(words) > 4
    assert rows_of(S.variants(S.counted_words(docs))) == answer(words)
    assert rows_of(S.variants(S.counted_words(no_docs))) == set()
