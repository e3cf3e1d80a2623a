"""The registered queries against their SQL, the libraries or brute force, and the pipeline against its stages' rules."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trialframe.llm import queries

from .conftest import SF
from .test_duplicates import Sets, fingerprint
from .test_scans import base


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def test_op2_is_the_library(spark, texts, ids):
    rows = queries.op2_token_counts(spark, SF).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {(i, len(t.encode()), len(ids[i]), len(ids[i]) > 512) for i, t in texts.items()}
    assert len(rows) == len(texts)


def test_op3_learns_languages(spark, docs):
    langs = {r.doc_id: r.lang for r in docs.collect()}
    rows = queries.op3_language(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in langs}
    assert all(r.lang_pred in {*langs.values(), "und"} and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.9


def test_op6_base_spans(spark, texts):
    rows = queries.op6_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert {x for x in r.spans.split(",") if x and not x.startswith("random")} == {x for x in joined.split(",") if x}


def test_op7_is_the_library(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    rows = queries.op7_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = sp.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(own).encode()).hexdigest()


def test_op8_is_brute_force(spark, texts):
    prints, sets = {i: fingerprint(t) for i, t in texts.items()}, Sets(texts)
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                sets.join(a, b)
    rows = queries.op8_simhash(spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((i, f"{p:016x}", sets.top(i)) for i, p in prints.items())


def test_op9_is_the_library(spark, ids):
    rows = {r.doc_id: r for r in queries.op9_token_files(spark, SF).collect()}
    assert set(rows) == set(ids)
    before = 0
    for i in sorted(ids):
        own = [*ids[i], 0]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (before, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        before += len(own)


def test_pipeline_run(spark, docs, texts):
    """The whole run keeps what its stages keep one by one, and tokenizes the texts with their secrets out."""
    import sentencepiece

    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
    left = {r.doc_id: r.text for r in at.collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(sp.encode(t)) for i, t in left.items()}
    assert 0.7 * len(texts) < len(rows) < len(texts)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


def test_pipeline_stages(spark, docs):
    extra = [(10**6, "   12 34", "en", "s", 8), (10**6 + 1, docs.head().text, "en", "s", 1), (10**6 + 2, "This token = 0123456789abcdef0123456789abcdef is here and more text follows in it.", "en", "s", 1)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").head().text
    extra.append((10**6 + 3, "Before all of it there is a word. " + item, "en", "s", 1))
    at = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
        ids[name] = {r.doc_id for r in at.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
        if name == "secrets":
            assert "0123456789abcdef" not in at.filter(F.col("doc_id") == 10**6 + 2).head().text
            assert at.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert 10**6 not in ids["language"] and len(ids["language"]) >= docs.count()
    assert 10**6 + 1 not in ids["near_dedup"] and docs.head().doc_id in ids["near_dedup"]
    assert 10**6 + 3 in ids["near_dedup"] and 10**6 + 3 not in ids["decontaminate"]
    assert ids["secrets"] == ids["decontaminate"] == ids["sentencepiece"]
    assert 10**6 + 2 in ids["sentencepiece"]
