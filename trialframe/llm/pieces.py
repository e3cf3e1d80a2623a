"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts become flat symbol arrays cut into words where a blank sign follows another character
(no piece of the vocabulary may hold such a place; this is checked). Each round finds every
word's least pair rank and merges its leftmost pair, in all words at once, until no pair
remains. Symbols that are no piece fall back to bytes. Decoding looks up each id's bytes.

Null text counts as empty: no ids, empty decoded text.

Every row is coded by itself: repeated rows, equal or null ids give rows of their own. Words of over 1,024 symbols (``merges.LONG``) are merged with a
heap instead of in rounds, with equal results. A text is one cell and one slice, however long. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, merges, words

BLANK = "▁"


class ByteTable:
    """Byte strings of ids, laid end to end."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.lens = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens

    def of(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, lens): the joined strings of each word's ids."""
        lens = self.lens[ids]
        size = common.sums(lens, np.r_[0, np.cumsum(counts)])
        return common.ragged_take(self.data, self.starts[ids], lens), np.cumsum(size) - size, size


class PieceModel:
    """A SentencePiece BPE model with byte fallback as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.vocab_size())
        pieces = [sp.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self._check(sp, pieces, plain, path)
        self.bytes = [b""] * len(pieces)
        self.of_byte = np.zeros(256, np.int32)
        for i in ids:
            if sp.is_byte(i):
                value = int(pieces[i][3:5], 16)
                self.of_byte[value] = i
                self.bytes[i] = bytes([value])
        for i in plain:
            self.bytes[i] = pieces[i].replace(BLANK, " ").encode()
        # symbols: pieces have their ids, and other single characters within pieces get further numbers
        number = {pieces[i]: i for i in plain}
        for i in plain:
            for c in pieces[i]:
                number.setdefault(c, len(pieces) + len(number))
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        rows = [(number[p[:k]], number[p[k:]], order[sp.get_score(number[p])], number[p]) for p in (pieces[i] for i in plain) for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        self.n_pieces = len(pieces)
        n_symbols = max(number.values()) + 1
        left, right, rank, out = np.array(rows, np.int64).reshape(-1, 4).T
        self.table = merges.PairTable(left, right, rank, out, n_symbols + 1)
        #: characters of each piece; the last entry is for symbols that are no piece
        self.width = np.ones(self.n_pieces + 1, np.int64)
        for i in plain:
            self.width[i] = len(pieces[i])
        self.decimal, self.plain = ByteTable([b"%d," % i for i in ids]), ByteTable(self.bytes)
        #: number of each single character; n_symbols for those that no piece holds
        self.of_char = np.full(0x110000, n_symbols, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i

    @staticmethod
    def _check(sp, pieces: list[str], plain: list[int], path: str) -> None:
        if any(sp.is_unused(i) for i in plain) or not any(sp.is_byte(i) for i in range(len(pieces))):
            raise ValueError(f"{path}: unused pieces, or no byte fallback")
        if any(BLANK in pieces[i].lstrip(BLANK) for i in plain):
            raise ValueError(f"{path}: a piece crosses a word's start")
        if sp.decode(sp.encode(" Ａ  b́ ")) != " Ａ  b́ " or not (first := sp.encode("x", out_type=str)) or first[0][0] != BLANK:
            raise ValueError(f"{path}: only models without normalisation and with a leading blank are supported")

    def encode(self, cp: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as code points (blank signs instead of blanks), and their number for each word."""
        flat, counts = merges.merge_words(self.of_char[cp], lens, self.table, every=False)
        odd = np.flatnonzero(flat >= self.n_pieces)
        if not len(odd):
            return flat, counts
        # a symbol that is no piece is one character, which its UTF-8 bytes stand for
        width = self.width[np.minimum(flat, self.n_pieces)]
        chars, which = np.unique(cp[(np.cumsum(width) - width)[odd]], return_inverse=True)
        raw = [chr(c).encode() for c in chars.tolist()]
        size = np.array([len(r) for r in raw], np.int64)
        times = np.ones(len(flat), np.int64)
        times[odd] = size[which]
        out = np.repeat(flat, times)
        ids = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        place = np.zeros(len(flat), bool)
        place[odd] = True
        out[np.repeat(place, times)] = common.ragged_take(ids, (np.cumsum(size) - size)[which], size[which])
        bounds = np.r_[0, np.cumsum(counts)]
        return out, common.sums(times, bounds)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of a text's ids; the leading blank is not part of the text."""
        joined = b"".join(map(self.bytes.__getitem__, ids))
        return joined[1:] if ids and self.bytes[ids[0]][:1] == b" " else joined


def encode_slice(strings: pa.LargeStringArray, model: PieceModel) -> Iterator[tuple[int, bytes, bytes]]:
    """(number of ids, ids as decimal text, decoded UTF-8) of each text."""
    _, cp, offsets = common.code_points(strings)
    # the words of a text are those of a blank sign followed by the text
    filled = np.diff(offsets) > 0
    padded = np.insert(np.where(cp == 0x20, np.uint32(0x2581), cp), offsets[:-1][filled], np.uint32(0x2581))
    text_starts = offsets + np.r_[0, np.cumsum(filled)]
    blank = padded == 0x2581
    is_start = np.zeros(len(padded) + 1, bool)
    is_start[1:-1] = blank[1:] & ~blank[:-1]
    is_start[text_starts] = True
    starts = np.flatnonzero(is_start[:-1])
    lens = np.diff(np.r_[starts, len(padded)])
    first, group = words.distinct(*words.word_hashes(padded.view(np.uint8), starts * 4, lens * 4, 2))
    ids, counts = model.encode(common.ragged_take(padded, starts[first], lens[first]), lens[first])
    bounds = np.searchsorted(starts, text_starts)
    n_tokens = common.sums(counts[group], bounds)
    joined = []
    for table in (model.decimal, model.plain):
        data, at, size = table.of(ids, counts)
        joined.append((common.ragged_take(data, at[group], size[group]), np.r_[0, np.cumsum(size[group])][bounds].tolist()))
    (decimal, d), (plain, p) = joined
    for i, k in enumerate(n_tokens.tolist()):
        text = plain[p[i] : p[i + 1]].tobytes()
        # each id ends in a comma, and the leading blank is not part of the text
        yield k, decimal[d[i] : max(d[i], d[i + 1] - 1)].tobytes(), text[1:] if text[:1] == b" " else text


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", ids: bool = False, decoded: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text and any that clash, with ``n_tokens``, ``ids_sha256`` (of the
    decimal ids joined by commas) and ``decoded_sha256`` (of the text that the ids decode to).

    ``ids`` adds the ids as ``token_ids`` (array of int), ``decoded`` the text as ``decoded_text``.
    """
    model = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * ids + ["decoded_text"] * decoded
    keep = [c for c in docs.columns if c != text and c not in added]
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    more = ", token_ids array<int>" * ids + ", decoded_text string" * decoded
    schema = common.with_fields(rows.drop("__text"), "n_tokens long, ids_sha256 string, decoded_sha256 string" + more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column("__text"))
            for a, b in common.text_slices(strings):
                out: list[list] = [[] for _ in added]
                for k, decimal, plain in encode_slice(strings.slice(a, b - a), model.value):
                    values = [k, hashlib.sha256(decimal).hexdigest(), hashlib.sha256(plain).hexdigest()]
                    if ids:
                        values.append([int(x) for x in decimal.split(b",")] if decimal else [])
                    if decoded:
                        values.append(plain.decode())
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = {"n_tokens": pa.int64(), "token_ids": pa.list_(pa.int32())}
                new = [pa.array(x, kinds.get(c, pa.string())) for c, x in zip(added, out, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), *new], [*keep, *added])

    return common.spread(rows).mapInArrow(run, schema)
