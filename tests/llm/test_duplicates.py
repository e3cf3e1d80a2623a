import hashlib
import random
import re

import pytest
import xxhash

from trialframe.llm import components, near_copies, recompress, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text, fold=True):
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if fold else text)


def fingerprint(text):
    w = words_of(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def test_simhash_against_brute_force(spark, docs):
    base = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9000, None), (9001, " "), (9002, "A b"), (9003, "a B")], "doc_id long, text string"))
    rows = base.collect()
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    sets = Sets(prints)
    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                sets.join(a, b)
    got = simhash.near_duplicates(base).collect()
    assert {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in got} == {i: (prints[i], sets.top(i)) for i in ids}


def test_ball_links_join_exactly_the_close_ones(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(8)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    sets = Sets(signed)
    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                sets.join(a, b)
    links = simhash.ball_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {r.node: r.component for r in components.components(links).collect()}
    assert {p: got.get(p, p) for p in signed} == {p: sets.top(p) for p in signed}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {150: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_on_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.component_id for r in rows if r.fp == 0 and r.doc_id is not None}
    assert len(empty) == 1
    assert simhash.near_duplicates(no_docs).count() == 0


def similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (words_of(a), words_of(b)))
    return len(x & y) / len(x | y)


@pytest.fixture(scope="module")
def planted(spark):
    """100 unrelated texts, exact copies of some, and copies with one word of 60 changed."""
    rng = random.Random(8)
    vocabulary = ["v%d" % i for i in range(2000)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(150, 400))] for _ in range(100)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    for i in range(30):
        t = list(texts[i])
        for k in range(i % 20, len(t), 120):
            t[k] = "changed%d" % k
        rows.append((1000 + i, " ".join(t)))
        rows.append((2000 + i, " ".join(texts[i]).upper() + "\n"))
    return rows


def test_near_copies_are_found_and_others_stay(spark, planted):
    df = spark.createDataFrame(planted, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.groups(df).collect()}
    texts = dict(planted)
    assert len(got) == len(planted)
    assert all(got[2000 + i] == got[i] for i in range(30))
    near = [i for i in range(30) if similarity(texts[i], texts[1000 + i]) >= 0.8]
    assert len(near) >= 20 and sum(got[1000 + i] == i for i in near) >= 0.9 * len(near)
    assert all(similarity(texts[d], texts[c]) >= 0.8 or d == c for d, c in got.items())
    assert near_copies.without_copies(df).count() == len(set(got.values()))


@pytest.mark.parametrize("orders", [3, 20])
def test_near_copies_behind_an_outlier(spark, orders):
    """Texts with equal words, and so equal fingerprints, in several orders; the least id is like none of the others."""
    rng = random.Random(orders)
    letters = ["t%d" % i for i in range(200)]
    texts = [rng.sample(letters, len(letters))]
    for _ in range(orders):
        order = rng.sample(letters, len(letters))
        for _ in range(4):
            t = list(order)
            for k in rng.sample(range(0, len(t) - 1, 2), rng.randrange(5)):
                t[k], t[k + 1] = t[k + 1], t[k]
            texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = Sets(range(len(rows)))
    for a, x in rows:
        for b, y in rows[:a]:
            if similarity(x, y) >= 0.8:
                low, high = sorted((sets.top(a), sets.top(b)))
                sets.up[high] = low
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.groups(df).collect()} == {i: sets.top(i) for i, _ in rows}


def test_near_copies_with_repeated_passages(spark):
    """Equal shingle sets, or nearly so, with other numbers of repeats; and a text that holds another one only."""
    rng = random.Random(5)
    line, text, other = (" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(30)) for c in "abc")
    rows = [(1, " ".join([line] * 10)), (2, " ".join([line] * 40)), (3, text), (4, " ".join([text] * 3)), (5, other), (6, f"{other} {line[::-1]}")]
    texts = dict(rows)
    assert similarity(texts[1], texts[2]) == 1 and similarity(texts[3], texts[4]) >= 0.8 > similarity(texts[5], texts[6])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.groups(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}


def test_near_copies_on_odd_rows(odd_docs, no_docs):
    stay = near_copies.without_copies(odd_docs)
    rows = stay.collect()
    assert stay.columns == odd_docs.columns
    # the first text without words stands for all of them, and null ids stay
    assert sum(r.doc_id is None for r in rows) == 2
    assert [r.doc_id for r in rows if r.doc_id is not None and not words_of(r.text)] == [0]
    assert near_copies.groups(no_docs).count() == 0


def brute_removal(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words_of(text, fold=False)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("rounds", [1, 3, 6])
def test_repeats_against_brute_force(spark, docs, rounds):
    rng = random.Random(rounds)
    base = [[rng.choice("abcd") if rng.random() < 0.3 else "w%d" % rng.randrange(500) for _ in range(300)] for _ in range(5)]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for i in range(150):
        w = []
        for _ in range(rng.randrange(6)):
            k = rng.randrange(5)
            if k == 0:
                w += ["a"] * rng.randrange(60)
            elif k == 1:
                w += ["a", "b"] * rng.randrange(40)
            elif k == 2:
                w += ["x%d" % rng.randrange(10**6) for _ in range(rng.randrange(30))]
            else:
                start = rng.randrange(250)
                w += rng.choice(base)[start : start + rng.randrange(5, 100)]
        rows.append((100_000 + i, "  ".join(w)))
    rows += [(200_000, None), (200_001, ""), (200_002, "\n")]
    out = recompress.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), rounds=rounds, kept=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute_removal(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in out)


def thue_morse(n, a, b):
    return [b if i.bit_count() % 2 else a for i in range(n)]


def planted_pairs(seed, count=100):
    """Pairs of texts that are 0.8 or more alike: by their end, their length, or a vocabulary of few words."""
    rng = random.Random(seed)

    def fresh(n, kinds=10**7):
        return [f"w{rng.randrange(kinds)}" for _ in range(n)]

    for _ in range(count):
        for long, added in ((300, 55), (100, 18), (40, 7), (20, 3)):
            t = fresh(long)
            yield f"{long}+{added}", t, t + fresh(added)
        line = fresh(10)
        yield "line", line * 5, line * 5 + fresh(2)
        t = [f"s{rng.randrange(6)}" for _ in range(300)]
        yield "few words", t, t + [f"s{rng.randrange(6)}" for _ in range(6)]
        t = fresh(250)
        u = list(t)
        for k in rng.sample(range(250), 5):
            u[k] = "changed"
        yield "changed", t, u


def test_recall_of_planted_near_copies(spark):
    kinds, rows = [], []
    for kind, a, b in planted_pairs(3):
        kinds.append((kind, similarity(" ".join(a), " ".join(b))))
        rows += [(2 * len(kinds) - 2, " ".join(a)), (2 * len(kinds) - 1, " ".join(b))]
    got = {r.doc_id: r.component_id for r in near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for kind in {k for k, _ in kinds}:
        near = [i for i, (k, alike) in enumerate(kinds) if k == kind and alike >= 0.8]
        assert len(near) >= 50 and sum(got[2 * i] == got[2 * i + 1] for i in near) >= 0.99 * len(near), kind
    assert all(got[2 * i] != got[2 * i + 1] for i, (_, alike) in enumerate(kinds) if alike < 0.8)


@pytest.mark.parametrize(("cell", "noise"), [(8, 0.02), (8, 0.035), (1000, 0.035)])
def test_one_large_family(spark, monkeypatch, cell, noise):
    """Copies of one text with random changes, in cells far smaller than their bucket, against all pairs."""
    monkeypatch.setattr(near_copies, "CELL", cell)
    rng = random.Random(9)
    origin = ["o%d" % i for i in range(120)]
    rows = [(i, " ".join(f"x{rng.randrange(10**6)}" if rng.random() < noise else w for w in origin)) for i in range(150)]
    rows += [(1000 + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    sets = Sets([i for i, _ in rows])
    for k, (a, x) in enumerate(rows):
        for b, y in rows[:k]:
            if similarity(x, y) >= 0.8:
                low, high = sorted((sets.top(a), sets.top(b)))
                sets.up[high] = low
    got = {r.doc_id: r.component_id for r in near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: sets.top(i) for i, _ in rows}


def test_rows_of_one_id(spark):
    """A text whose id another text has as well goes or stays by itself; repeated rows stay together."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b + " end"), (8, c), (8, c), (9, None), (9, ""), (4, " ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    stay = sorted(((r.doc_id, r.text) for r in near_copies.without_copies(df).collect()), key=repr)
    assert stay == sorted([(1, a), (5, b), (5, b), (8, c), (8, c), (4, " ")], key=repr)


@pytest.fixture(scope="module")
def structured(spark):
    """Texts that differ only in the arrangement of two letters within a word, or of two words."""
    start = ["s%d" % i for i in range(11)]
    end = ["e%d" % i for i in range(11)]
    rows = [(i, " ".join([*start, "".join(thue_morse(1024, *pair)), *end])) for i, pair in enumerate(("ab", "ba"))]
    rows += [(10 + i, " ".join(thue_morse(1024, *pair))) for i, pair in enumerate((("x", "y"), ("y", "x"), ("p", "q")))]
    return rows


def test_structured_words_and_texts_are_told_apart(spark, structured):
    df = spark.createDataFrame(structured, "doc_id long, text string")
    out = recompress.remove_repeats(df).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute_removal(structured)
    assert {r.doc_id: r.n_removed for r in out}[1] == 0
    sets = Sets([i for i, _ in structured])
    for a, x in structured:
        for b, y in structured:
            if a < b and similarity(x, y) >= 0.8:
                sets.join(a, b)
    assert {r.doc_id: r.component_id for r in near_copies.groups(df).collect()} == {i: sets.top(i) for i, _ in structured}


def test_repeats_on_odd_rows(odd_docs, no_docs):
    out = recompress.remove_repeats(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert recompress.remove_repeats(no_docs).count() == 0
    twice = odd_docs.filter("doc_id = 8").union(odd_docs.filter("doc_id = 8"))
    assert sorted(r.n_removed == r.n_words for r in recompress.remove_repeats(twice).collect()) == [False, True]


def test_one_exchange_of_the_texts(docs):
    plan = recompress.remove_repeats(docs)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(exchanges) == 1 and "ReusedExchange" in final
