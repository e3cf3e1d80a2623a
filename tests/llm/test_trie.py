"""The prefix trie against plain dictionaries of sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from trialframe.llm import prefix_trie as P
from trialframe.llm import queries

from .conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def answer(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(first, [])[:h] + turns[h:]
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        path = tuple(built[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                kids[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in kids[k])
    sha = {k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest() for k in members}
    return sorted(((m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(kids[k]), leaves[k], saved[k], sha[k]) for k, m in members.items()), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def test_query_is_brute_force(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert rows_of(queries.op13_prefix_trie(spark, SF)) == answer(rows)


@pytest.mark.parametrize("size", [1, 16, 4096])
def test_shared_prefixes(spark, size):
    """Most conversations share their first turns; some have null or equal turns, odd roles, negative ids, no turns of their own."""
    rng = random.Random(size)
    rows = [(rng.choice((-1, 1)) * rng.randrange(200) if rng.random() < 0.9 else None, rng.choice((None, 0, 0, 1, 2, 3, 4)), rng.choice((None, "", "user")), rng.choice((None, "", "a", " a b\n", "é 日 x"))) for _ in range(600)]
    rows += [(1000 + i, t, "user", "hello there") for i in range(60) for t in range(1 + i % 5)]
    rows += [(10**15, 0, "u", "x"), (10**15, 0, "u", "x"), (777777, None, None, "w " * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert rows_of(P.prefix_nodes(df, size)) == answer(rows)


def test_long_conversation(spark):
    rows = [(c, t, "u", f"t{t % 3}") for c in (0, 1, 2) for t in range(3000)]
    assert rows_of(P.prefix_nodes(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))) == answer(rows)


def test_no_conversations(spark):
    assert rows_of(P.prefix_nodes(spark.createDataFrame([], SCHEMA))) == []
    assert rows_of(P.prefix_nodes(spark.createDataFrame([(None, 0, "u", "x", None)], SCHEMA))) == []
