"""Words of many texts as ragged arrays: fingerprints, distinct words, pre-token boundaries."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import numpy as np

_U = np.uint64
#: for each of two independent fingerprints: start value and multiplier
_SEEDS = ((0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD), (0x2545F4914F6CDD1D, 0xC2B2AE3D27D4EB4F))
#: the first 0 to 8 bytes of a chunk
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)
#: longer words are hashed one by one
LONG_WORD = 256


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xA0761D6478BD642F)
    h ^= h >> _U(32)
    return h


def word_hashes(raw: np.ndarray, starts: np.ndarray, lens: np.ndarray, n: int = 1) -> list[np.ndarray]:
    """``n`` (1 or 2) independent 64-bit fingerprints of the words raw[start : start + len] (bytes).

    A word is taken in chunks of eight bytes, and each chunk is scrambled together with all before it, so
    no arrangement of letters cancels out; words of up to eight bytes and of one length never collide.
    Words of more than LONG_WORD bytes get their BLAKE2 digest.
    """
    view = np.ndarray((len(raw) + 1,), "<u8", buffer=np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))
    hashes = [mixed(lens.astype(_U) + _U(seed)) for seed, _ in _SEEDS[:n]]
    rows, at, left = None, starts, lens
    if len(lens) and int(lens.max()) > LONG_WORD:
        long = np.flatnonzero(lens > LONG_WORD)
        for i in long.tolist():
            digest = np.frombuffer(hashlib.blake2b(raw[starts[i] : starts[i] + lens[i]].tobytes(), digest_size=16).digest(), "<u8")
            for h, value in zip(hashes, digest, strict=False):
                h[i] = value
        rows = np.flatnonzero(lens <= LONG_WORD)
        at, left = starts[rows], lens[rows]
    while len(at):
        chunk = view[at] & _MASKS[np.minimum(left, 8)]
        for k, (_, step) in enumerate(_SEEDS[:n]):
            if rows is None:
                hashes[k] = mixed((hashes[k] ^ chunk) * _U(step))
            else:
                hashes[k][rows] = mixed((hashes[k][rows] ^ chunk) * _U(step))
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return hashes


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of two neighbours from theirs."""
    return mixed(a * _U(0x9FB21C651E98DF25) + b * _U(0xC4CEB9FE1A85EC53) + _U(1))


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of hashes[start:end] for each start and end: its length and the blocks of powers of two that tile it,
    the largest first; a block is its two halves joined."""
    size = ends - starts
    out, at, blocks = mixed(size.astype(_U)), starts.copy(), [hashes]
    for k in range(1, int(size.max(initial=0)).bit_length()):
        last, half = blocks[-1], 1 << (k - 1)
        blocks.append(joined(last[:-half], last[half:]))
    for k in reversed(range(len(blocks))):
        own = np.flatnonzero(size >> k & 1)
        out[own] = joined(out[own], blocks[k][at[own]])
        at[own] += 1 << k
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each ``width`` consecutive symbols (over text bounds too; drop those by their bounds)."""
    starts = np.arange(max(len(hashes) - width + 1, 0))
    return range_hashes(hashes, starts, starts + width)


def distinct(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, group): a representative of each distinct pair of fingerprints, and each row's group.

    Rows are sorted by the high bits of ``h1``; should these be equal in different words, a word may get more than
    one group, but no group holds two words.
    """
    n = len(h1)
    bits = _U(max(n, 1).bit_length())
    keys = np.sort((h1 >> bits << bits) | np.arange(n, dtype=_U))
    order = (keys & ((_U(1) << bits) - _U(1))).astype(np.int64)
    a, b = h1[order], h2[order]
    new = np.ones(n, bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


class Recent:
    """What was worked out for words, kept while there is room: ``slots`` words, one to a slot, and their values (lists of
    ids) in a pool of about ``pool`` numbers. Its memory is bounded, and it only saves time. It belongs to one encoder."""

    def __init__(self, dtype: np.dtype, slots: int = 1 << 20, pool: int = 8_000_000):
        self.mask, self.limit = _U(slots - 1), pool
        self.h1, self.h2 = np.zeros(slots, _U), np.zeros(slots, _U)
        self.at, self.n = np.zeros(slots, np.int64), np.full(slots, -1, np.int32)
        self.values, self.used = np.zeros(1 << 16, dtype), 0

    def of(self, raw: np.ndarray, starts: np.ndarray, lens: np.ndarray, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(at, n) of each word: its values are self.values[at : at + n]. ``make`` gives the values of words not
        seen lately, and their number for each word."""
        if self.used > self.limit:
            self.n[:], self.used = -1, 0
        h1, h2 = word_hashes(raw, starts, lens, 2)
        slot = (h1 & self.mask).astype(np.int64)
        at, n = self.at[slot], self.n[slot].astype(np.int64)
        missing = np.flatnonzero((self.h1[slot] != h1) | (self.h2[slot] != h2) | (n < 0))
        if len(missing):
            first, group = distinct(h1[missing], h2[missing])
            kinds = missing[first]
            data, a = raw.tobytes(), starts[kinds]
            made, counts = make([data[x:y] for x, y in zip(a.tolist(), (a + lens[kinds]).tolist(), strict=True)])
            if self.used + len(made) > len(self.values):
                self.values = np.concatenate([self.values[: self.used], np.zeros(self.used + 2 * len(made), self.values.dtype)])
            self.values[self.used : self.used + len(made)] = made
            ends = np.cumsum(counts) + self.used
            self.used += len(made)
            at[missing], n[missing] = (ends - counts)[group], counts[group]
            own, k = np.unique(slot[kinds], return_index=True)
            k = kinds[k]
            self.h1[own], self.h2[own], self.at[own], self.n[own] = h1[k], h2[k], at[k], n[k]
        return at, n


@functools.cache
def char_classes() -> np.ndarray:
    """Class of each code point as the tokenizers library's own patterns see it:
    1 letter, 2 number, 3 white space, 0 other."""
    from tokenizers import Regex, pre_tokenizers

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text, where = "".join(map(chr, points)), np.array(points)
    classes = np.zeros(0x110000, np.uint8)
    for value, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
        inside = np.ones(len(points), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern + "+"), "removed").pre_tokenize_str(text):
            inside[a:b] = False
        classes[where[inside]] = value
    return classes


def pretoken_starts(cp: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Start of every pre-token of the byte-level BPE pattern (contractions; runs of letters,
    numbers or other signs with at most one leading blank; white space less its last character
    before something else). Pre-tokens tile the texts, and none crosses a text's bounds."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    cls = classes[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    prev = np.empty(n, np.uint8)
    prev[0] = 9
    prev[1:] = cls[:-1]
    prev[first] = 9  # no character before
    change = prev != cls
    start = change | first
    # after white space the last of its characters stands apart, or, as a blank, goes with what follows
    after = np.flatnonzero(change & (prev == 3))
    start[after - 1] = True
    start[after[cp[after - 1] == 0x20]] = False
    # contractions: an apostrophe that opens a run, has no blank before it, and is followed by one of the endings
    quote = np.flatnonzero((cp == 0x27) & change)
    quote = quote[(quote + 1 < n)]
    quote = quote[(prev[quote] == 9) | (cp[np.maximum(quote - 1, 0)] != 0x20)]
    quote = quote[~first[quote + 1]]
    one = cp[quote + 1]
    short = np.isin(one, [ord(c) for c in "stmd"])
    two = np.zeros(len(quote), bool)
    at = np.flatnonzero(quote + 2 < n)
    nxt = cp[quote[at] + 2]
    whole = ~first[quote[at] + 2]
    for a, b in ("re", "ve", "ll"):
        two[at] |= (one[at] == ord(a)) & (nxt == ord(b)) & whole
    for found, length in ((quote[short], 2), (quote[two & ~short], 3)):
        start[found + 1] = False
        if length == 3:
            start[found + 2] = False
        ends = found + length
        ends = ends[ends < n]
        # an end that is a blank before a word still opens the next pre-token
        start[ends] = True
    return np.flatnonzero(start)


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: blank, tab, line feed, vertical tab, form feed, carriage return
BLANKS = separators(b" \t\n\x0b\x0c\r")


def byte_words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lens, bounds) of the words in UTF-8 bytes; bounds number the words where each text begins."""
    inside = ~separator[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]  # no word goes on from one text into the next
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1 - starts, np.searchsorted(starts, offsets)


def sequence_digests(raw: np.ndarray, starts: np.ndarray, lens: np.ndarray, first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The two halves of the BLAKE2 digest of the words first to end - 1, joined by blanks, for each first and end."""
    flat = np.append(raw, np.uint8(0))
    size = lens + 1
    stops = np.cumsum(size)
    flat = flat[np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - stops + size, size)]
    flat[stops - 1] = 0x20
    data, digest, begins = flat.tobytes(), hashlib.blake2b, np.append(0, stops)
    spans = zip(begins[first].tolist(), np.maximum(begins[end] - 1, begins[first]).tolist(), strict=True)
    found = np.frombuffer(b"".join([digest(data[a:b], digest_size=16).digest() for a, b in spans]), "<i8")
    return [found[0::2].astype(np.int64), found[1::2].astype(np.int64)]
