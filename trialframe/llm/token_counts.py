"""Token counts by rank-synchronous array merging (byte-level BPE).

The vocabulary file is read on the driver and sent to the executors once: its size is fixed
by the vocabulary, not by the data. On the executors each slice of texts becomes one flat
array of code points; pre-token boundaries, distinct pre-tokens and merges are array
operations. In a merge round every pre-token applies its lowest-rank pair at all places at
once. Each vocabulary keeps a bounded cache of pre-token counts, which only saves time.

Null text counts as empty (0 bytes, 0 tokens). Special strings of the vocabulary inside a
text are one token each and end the pre-tokens beside them, as the library does by default.

Every row is counted by itself: repeated rows, equal or null ids give rows of their own, and other columns pass by unused. Pre-tokens of over 1,024
bytes (``merges.LONG``) are merged with a heap instead of in rounds, with equal results. A text is one cell and one slice, however long. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, merges, words


def byte_letters() -> list[str]:
    """The printable stand-in for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE vocabulary (tokenizers JSON) as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError(f"{path}: only plain byte-level BPE without normalizer is supported")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in their surroundings are not supported")
        self.of_byte = np.array([vocab[c] for c in byte_letters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        out = np.array([vocab[a + b] for a, b in pairs], np.int64)
        #: classes of all code points, and:
        #: with one way to make each token, a new pair never ranks below the one just merged,
        #: so that merging all places of a pair at once equals merging from the left one by one
        self.classes = words.char_classes()
        self.every = len(set(out.tolist())) == len(out)
        self.table = merges.PairTable(left, right, np.arange(len(pairs)), out, len(vocab) + len(self.special))

        self.recent = words.Recent(np.dtype(np.int32))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "recent"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"recent": words.Recent(np.dtype(np.int32))}

    def encode(self, kinds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids and their number for each pre-token of the list."""
        lens = np.array([len(w) for w in kinds], np.int64)
        return merges.merge_words(self.of_byte[np.frombuffer(b"".join(kinds), np.uint8)], lens, self.table, self.every)

    def counts(self, raw: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Number of tokens of each pre-token raw[start : start + len]."""

        def make(kinds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            return self.encode(kinds)[1], np.ones(len(kinds), np.int64)

        at, _ = self.recent.of(raw, starts, lens, make)
        return self.recent.values[at]


def split_special(strings: pa.LargeStringArray, special: Iterable[str]) -> tuple[pa.LargeStringArray, np.ndarray, list[list[str]]]:
    """Texts cut at special strings: (pieces, owner of each piece, special strings after pieces).

    The third is the list of special strings of each text in order. Texts without any are one piece.
    """
    import re

    import pyarrow.compute as pc

    special = list(special)
    pattern = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)))
    none: list[list[str]] = [[]] * len(strings)
    if not special:
        return strings, np.arange(len(strings)), none
    has = np.zeros(len(strings), bool)
    for s in special:
        has |= pc.match_substring(strings, s).to_numpy(zero_copy_only=False)
    if not has.any():
        return strings, np.arange(len(strings)), none
    pieces, owner, found = [], [], []
    for i, text in enumerate(strings.to_pylist()):
        parts = pattern.split(text) if has[i] else [text]
        found.append(pattern.findall(text) if has[i] else [])
        pieces += parts
        owner += [i] * len(parts)
    return pa.array(pieces, pa.large_string()), np.array(owner, np.int64), found


def pretokens(strings: pa.LargeStringArray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lens, bounds): the pre-tokens of a slice; bounds number them where each string begins."""
    raw = common.byte_view(strings)[0]
    _, cp, offsets = common.code_points(strings)
    starts = words.pretoken_starts(cp, offsets, classes)
    bounds = np.searchsorted(starts, offsets)
    if len(cp) != len(raw):  # from characters to bytes
        starts = np.flatnonzero((raw & 0xC0) != 0x80)[starts]
    return raw, starts, np.diff(np.r_[starts, len(raw)]), bounds


def count_slice(strings: pa.LargeStringArray, bpe: ByteBpe) -> np.ndarray:
    """Tokens of each text."""
    pieces, owner, found = split_special(strings, bpe.special)
    raw, starts, lens, bounds = pretokens(pieces, bpe.classes)
    of_piece = common.sums(bpe.counts(raw, starts, lens), bounds)
    return np.bincount(owner, of_piece, len(strings)).astype(np.int64) + np.array([len(x) for x in found], np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """All columns of ``docs`` but the text and any that clash with the new ones, with ``n_bytes``,
    ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    bpe = spark.sparkContext.broadcast(ByteBpe(tokenizer_path))
    added = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in docs.columns if c != text and c not in added]
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column("__text"))
            for a, b in common.text_slices(strings):
                part = strings.slice(a, b - a)
                n_tokens = count_slice(part, bpe.value)
                columns = [batch.column(c).slice(a, b - a) for c in keep]
                n_bytes = np.diff(common.byte_view(part)[1])
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], [*keep, "n_bytes", "n_tokens"])

    return common.spread(rows).mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
