import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from trialframe.llm import common, merges, pieces, token_counts, token_files, words

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def fuzz(alphabet, n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(n)]


MIXED = [*"ab 's'stmdrevell  \n\t.!12é日𠮷 　́'", "<|endoftext|>", "'re", " the"]
LONG = ["a" * 5000, "ab" * 3000, " " * 3000, "theing" * 500]


def test_counts_equal_the_library(library):
    texts = fuzz(MIXED, 3000) + LONG
    bpe = token_counts.ByteBpe(BPE)
    got = token_counts.count_slice(pa.array(texts, pa.large_string()), bpe)
    assert got.tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_count_query_on_odd_rows(odd_docs, no_docs, library):
    rows = token_counts.token_counts(odd_docs, BPE, limit=100).join(odd_docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(rows) >= 13
    for r in rows:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids)) or r.doc_id is None
        assert r.over_limit == (r.n_tokens > 100)
    out = token_counts.token_counts(odd_docs, BPE)
    assert out.count() == odd_docs.count() and out.columns == ["doc_id", "lang", "spans", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.token_counts(no_docs, BPE).count() == 0


def test_pieces_equal_the_library(sp):
    texts = fuzz([*"ab theinr 's'12.  \n\té日𠮷 　▁\x00", "<s>", "<0x41>", " the", "    ", "�"], 5000) + LONG + ["1" * 2000, "", " "]
    model = pieces.PieceModel(PIECES)
    for text, (n, decimal, plain) in zip(texts, pieces.encode_slice(pa.array(texts, pa.large_string()), model), strict=True):
        ids = sp.encode(text)
        assert (n, decimal.decode(), plain.decode()) == (len(ids), ",".join(map(str, ids)), sp.decode(ids)), text[:40]
        assert model.decode(ids).decode() == sp.decode(ids)


def test_piece_query_on_odd_rows(odd_docs, no_docs, sp):
    out = pieces.encode_decode(odd_docs, PIECES, ids=True, decoded=True)
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect() if r.doc_id is not None}
    rows = [r for r in out.collect() if r.doc_id is not None]
    for r in rows:
        ids = sp.encode(texts[r.doc_id])
        assert (r.token_ids, r.decoded_text, r.n_tokens) == (ids, sp.decode(ids), len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert out.count() == odd_docs.count() and pieces.encode_decode(no_docs, PIECES).count() == 0


@pytest.mark.parametrize("every", [False, True])
def test_merge_rounds_equal_the_heap(every):
    rng = np.random.default_rng(3)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(6), np.arange(6)))
    out = np.arange(6, 6 + len(left))
    # only pairs of first symbols merge, so that no new pair ranks below an old one
    table = merges.PairTable(left, right, rng.permutation(len(left)), out, 6 + len(left))
    lens = rng.integers(1, 40, 200)
    symbols = rng.integers(0, 6, lens.sum())
    flat, counts = merges.merge_rounds(symbols, lens, table, every)
    ends, at = np.cumsum(counts), np.cumsum(lens)
    for i in range(len(lens)):
        own = symbols[at[i] - lens[i] : at[i]].tolist()
        assert flat[ends[i] - counts[i] : ends[i]].tolist() == merges.merge_long(own, table.plain(), int(table.n))


def test_distinct_words():
    rng = np.random.default_rng(2)
    h1, h2 = rng.integers(0, 40, 3000).astype(np.uint64), rng.integers(0, 3, 3000).astype(np.uint64)
    h1[::2] <<= np.uint64(40)  # both above and below the bits that rows are sorted by
    first, group = words.distinct(h1, h2)
    assert (h1[first][group] == h1).all() and (h2[first][group] == h2).all()
    assert [len(x) for x in words.distinct(h1[:0], h2[:0])] == [0, 0]


def thue_morse(n, a, b):
    return [b if i.bit_count() % 2 else a for i in range(n)]


@pytest.mark.parametrize("n", [16, 256, 1024])
def test_word_hashes_tell_structured_words_apart(n):
    kinds = ["".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a")), "a" * n, "b" * n, "a" * (n - 1) + "b", "ab" * (n // 2)]
    raw = np.frombuffer("".join(kinds).encode(), np.uint8)
    starts = np.arange(len(kinds)) * n
    for h in words.word_hashes(raw, starts, np.full(len(kinds), n), 2):
        assert len(set(h.tolist())) == len(kinds)
    one, two = words.word_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 1]), np.array([1, 1]))[0]
    rows = [thue_morse(n, one, two), thue_morse(n, two, one), [one] * n, [one, two] * (n // 2)]
    flat = np.array([x for r in rows for x in r], np.uint64)
    starts = np.arange(len(rows)) * n
    assert len(set(words.range_hashes(flat, starts, starts + n).tolist())) == len(rows)


def test_range_hashes_depend_on_content_alone():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 3, 500).astype(np.uint64)
    starts = rng.integers(0, 480, 2000)
    ends = starts + rng.integers(0, 21, 2000)
    seen = {}
    for a, b, key in zip(starts.tolist(), ends.tolist(), words.range_hashes(h, starts, ends).tolist(), strict=True):
        assert seen.setdefault(key, h[a:b].tobytes()) == h[a:b].tobytes()
    assert len(seen) == len({h[a:b].tobytes() for a, b in zip(starts, ends, strict=True)})


def test_recent_words_are_bounded_and_right():
    recent, rng = words.Recent(np.dtype(np.int64), slots=8, pool=100), random.Random(7)

    def make(kinds):
        return np.array([x for w in kinds for x in w], np.int64), np.array([len(w) for w in kinds])

    for _ in range(200):
        kinds = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(6))) for _ in range(5)]
        lens = np.array([len(w) for w in kinds])
        raw = np.frombuffer(b"".join(kinds), np.uint8)
        at, n = recent.of(raw, np.cumsum(lens) - lens, lens, make)
        assert [bytes(recent.values[a : a + k].astype(np.uint8)) for a, k in zip(at, n, strict=True)] == kinds
        assert recent.used <= 130


@pytest.fixture(scope="module")
def other_bpe(tmp_path_factory):
    """The vocabulary with its first 200 merges only."""
    import json

    with open(BPE, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    made = {"".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"][200:]}
    model["merges"] = model["merges"][:200]
    model["vocab"] = {t: i for t, i in model["vocab"].items() if t not in made}
    path = tmp_path_factory.mktemp("vocab") / "other.json"
    path.write_text(json.dumps(spec))
    return str(path)


def test_two_vocabularies_in_one_session(spark, docs, library, other_bpe):
    from tokenizers import Tokenizer

    texts = {r.doc_id: r.text for r in docs.collect()}
    for path in (other_bpe, BPE, other_bpe):
        tokenizer = Tokenizer.from_file(path)
        ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
        assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()} == {i: len(x) for i, x in ids.items()}
        out = common.new_path(spark, "files")
        token_files.write_files(docs, path, out)
        assert {r.doc_id: r.ids for r in token_files.read_files(spark, out, with_ids=True).collect()} == {i: [*x, 0] for i, x in ids.items()}


def code_round_trip(ids, n):
    counts = dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)], strict=True))
    code = token_files.Code.of_counts(counts, int(ids.max()) + 1)
    raw, offsets, marks = code.pack(ids, n)
    starts = np.concatenate([m + o * 8 for m, o in zip(marks, offsets[:-1], strict=True)])
    sizes = np.concatenate([np.minimum(token_files.STEP, k - np.arange(0, k, token_files.STEP)) for k in n])
    assert (code.unpack(raw, starts, sizes) == ids).all()
    assert code.length.max() <= code.limit
    return code


def test_code_round_trips_and_is_optimal():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 20_000) % 5000
    code = code_round_trip(ids, np.array([1, 5000, 512, 513, 20_000 - 6026]))
    used = code.length[np.unique(ids)]
    assert (2.0**-used).sum() == 1
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert -(p * np.log2(p)).sum() <= (p * used).sum() < -(p * np.log2(p)).sum() + 0.1
    code_round_trip(np.zeros(7, np.int64), np.array([7]))


def test_length_limit_on_steep_counts():
    weights = np.array([2**k for k in range(40)])
    lengths = token_files.code_lengths(weights, 16)
    assert lengths.max() <= 16 and (2.0**-lengths).sum() == 1 and (np.diff(lengths) <= 0).all()


def test_files_read_back(spark, odd_docs, library):
    path = common.new_path(spark, "files")
    token_files.write_files(odd_docs, BPE, path)
    rows = token_files.read_files(spark.newSession(), path, with_ids=True).collect()  # the files are enough
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect() if r.doc_id is not None}
    before = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == before
        before += r.n_tokens
        if r.doc_id is not None:
            ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
            assert (r.ids, r.ids_crc32) == (ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])


def test_no_documents_no_files(spark, no_docs):
    path = common.new_path(spark, "files")
    token_files.write_files(no_docs, BPE, path)
    assert token_files.read_files(spark, path).count() == 0
