"""Byte-pair merges on flat symbol arrays, many words at a time."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)
#: Words of more symbols than this go through ``merge_long``: rounds over one giant word would be quadratic.
LONG = 1024


class PairTable:
    """rank and result of each pair of symbols that may merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, out: np.ndarray, n_symbols: int):
        self.n = np.int64(n_symbols)
        keys = left.astype(np.int64) * self.n + right
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.ranks = np.append(rank[order].astype(np.int32), NONE)
        self.outs = np.append(out[order].astype(np.int32), np.int32(-1))
        bits = max(8, int(np.ceil(np.log2(len(keys) + 1))) + 4)
        #: pairs whose slot is False can't merge; this spares most searches
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self._slot(keys)] = True
        self._plain: dict[int, tuple[int, int]] | None = None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, result) of each pair; rank NONE where it can't merge."""
        rank, out = np.full(len(left), NONE, np.int32), np.full(len(left), -1, np.int32)
        keys = left.astype(np.int64) * self.n + right
        some = np.flatnonzero(self.maybe[self._slot(keys)])
        at = np.searchsorted(self.keys, keys[some])
        hit = self.keys[at] == keys[some]
        rank[some[hit]], out[some[hit]] = self.ranks[at[hit]], self.outs[at[hit]]
        return rank, out

    def plain(self) -> dict[int, tuple[int, int]]:
        """The table as a dictionary, made once where very long words need it."""
        if self._plain is None:
            self._plain = dict(zip(self.keys[:-1].tolist(), zip(self.ranks[:-1].tolist(), self.outs[:-1].tolist(), strict=True), strict=True))
        return self._plain

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_plain": None}


def merge_rounds(symbols: np.ndarray, lens: np.ndarray, table: PairTable, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words to the end; (symbols, lengths) of the words, in order.

    A round finds each word's least rank and merges its leftmost pair (``every`` False) or all
    its pairs of that rank that don't overlap, from the left (``every`` True), in all words at
    once. Words without a pair left are set aside and the rest is compacted.
    """
    sym = symbols.astype(np.int32)
    word = np.repeat(np.arange(len(lens)), lens)
    done_sym, done_word = [], []
    rank, out = _ranks(sym, word, table)
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[starts, len(sym)])
        least = np.repeat(np.minimum.reduceat(rank, starts), size)
        over = least == NONE
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
            keep = ~over
            sym, word, rank, out, least = sym[keep], word[keep], rank[keep], out[keep], least[keep]
            if not len(sym):
                break
        at = np.flatnonzero(rank == least)
        if every:
            step = np.r_[True, np.diff(at) != 1]
            head = np.maximum.accumulate(np.where(step, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
        else:
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
        sym[at] = out[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        place = (np.cumsum(keep) - 1)[at]
        sym, word, rank, out = sym[keep], word[keep], rank[keep], out[keep]
        near = np.zeros(len(sym) + 1, bool)
        near[place] = near[place - 1] = True  # place 0 marks the spare last element, which is cut off
        touched = np.flatnonzero(near[:-1])
        rank[touched], out[touched] = _ranks_at(sym, word, touched, table)
    if not done_sym:
        return np.zeros(0, np.int32), np.zeros(len(lens), np.int64)
    all_sym, all_word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(all_word, kind="stable")
    return all_sym[order], np.bincount(all_word, minlength=len(lens))


def _ranks(sym: np.ndarray, word: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    return _ranks_at(sym, word, np.arange(len(sym)), table)


def _ranks_at(sym: np.ndarray, word: np.ndarray, at: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    rank, out = np.full(len(at), NONE, np.int32), np.full(len(at), -1, np.int32)
    inner = np.flatnonzero(at < len(sym) - 1)
    inner = inner[word[at[inner]] == word[at[inner] + 1]]
    p = at[inner]
    rank[inner], out[inner] = table.find(sym[p], sym[p + 1])
    return rank, out


def merge_long(symbols: list[int], pairs: dict[int, tuple[int, int]], n_symbols: int) -> list[int]:
    """The same merges for one very long word, by a heap of (rank, position): n log n steps."""
    sym, n = list(symbols), len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def push(i: int) -> None:
        j = right[i]
        if j < n and (found := pairs.get(sym[i] * n_symbols + sym[j])):
            heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = right[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i], sym[j] = new, -1
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        push(i)
        if left[i] >= 0:
            push(left[i])
    return [s for s in sym if s >= 0]


def merge_words(symbols: np.ndarray, lens: np.ndarray, table: PairTable, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """``merge_rounds`` for ordinary words and ``merge_long`` for very long ones."""
    big = np.flatnonzero(lens > LONG)
    if not len(big):
        return merge_rounds(symbols, lens, table, every)
    ends = np.cumsum(lens)
    pairs = table.plain()
    small = lens <= LONG
    flat, counts = merge_rounds(symbols[np.repeat(small, lens)], lens[small], table, every)
    results = np.split(flat, np.cumsum(counts)[:-1])
    merged: list[np.ndarray] = [np.zeros(0, np.int32)] * len(lens)
    for i, part in zip(np.flatnonzero(small), results, strict=False):
        merged[i] = part
    for i in big:
        merged[i] = np.array(merge_long(symbols[ends[i] - lens[i] : ends[i]].tolist(), pairs, int(table.n)), np.int32)
    return np.concatenate(merged), np.array([len(x) for x in merged])
