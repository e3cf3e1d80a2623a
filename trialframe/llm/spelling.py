"""Spelling variants: words within one edit, found in a trie of frequency vectors.

The letters are dealt into groups, frequent letters first, and a word's frequency vector holds its number of letters of each group.
A trie arranges the words by the successive counts; its leaves hold words of equal vectors. One inserted, deleted or replaced letter
changes the vector by at most one surplus and at most one deficit. So a depth-first search takes, at every level, the children
with an equal count and, while its budget of one surplus and one deficit lasts, those with one more or one less. Words of two leaves
that an edit parts also share their first or their last k letters, k being half the shorter length; a leaf's words are
looked up by these halves, so that a large leaf isn't compared as a whole. What is left is verified letter by letter.

Spark shards the trie: a shard is the subtree below one path of the first ``levels`` counts. ``levels`` is the least number at which no subtree has
more than SHARD_WORDS words (or all groups). Each word is stored in its own shard and searched for in those that the budget reaches, 1 + levels + levels ** 2
at most. Shards return, for each word, the number of near words and the best of them, which Spark adds up.

Words come from ``counted_words``: runs of letters of the texts, as the contract of the query has them. Null text has no
words, a null ``doc_id`` counts as the empty string, repeated rows count again, other columns don't matter. Of near words that are equally frequent, the
smallest in code-point order is the form. A text is one row, however long; words of over WIDTH letters are verified one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, words

GROUPS = 12
#: words of the largest subtree that makes a shard
SHARD_WORDS = 20_000
#: states of the search that are expanded at a time
BLOCK = 200_000
#: longer words are compared one by one
WIDTH = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = r"[^A-Za-zÀ-ÿ]+"


def letter_runs(text: Column) -> Column:
    """The runs of letters of a text, which may start and end with an empty string."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), OTHER)


def lowered(run: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def counted_words(docs: DataFrame, shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n): words of at least ``shortest`` letters that occur ``least`` times in all texts. Where ``every`` divides the CRC-32 of
    "doc_id:run", the run's letter at that number modulo its length is left out."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc_id"), F.explode(letter_runs(F.col("text"))).alias("run")).filter(F.length("run") >= shortest)
    runs = runs.select("doc_id", lowered(F.col("run")).alias("run")).select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, without).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def letter_groups(counts: dict[str, int], groups: int = GROUPS) -> np.ndarray:
    """Group of each letter (code points up to 255): letters from the most frequent on, each to the group with the fewest letters so far
    by count; the first groups hold the most frequent letters."""
    table, load = np.full(256, groups - 1, np.uint8), [0] * groups
    for letter, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        g = load.index(min(load))
        table[ord(letter)] = g
        load[g] += n
    return table


def letters_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters (one byte each) and the n + 1 offsets of the words."""
    data = [w.encode("latin-1") for w in column.to_pylist()]
    return np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int64)


def vectors(letters: np.ndarray, offsets: np.ndarray, table: np.ndarray, groups: int) -> np.ndarray:
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return np.bincount(owner * groups + table[letters], minlength=(len(offsets) - 1) * groups).reshape(-1, groups).astype("<u4")


def reachable(path: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, paths): for each way to spend the budget, the rows where it leads to a path, and the paths; the paths themselves first."""
    n, levels = path.shape
    yield np.arange(n), path
    for up in range(-1, levels):
        for down in range(-1, levels):
            if up == down:
                continue
            rows = np.arange(n) if down < 0 else np.flatnonzero(path[:, down] > 0)
            moved = path[rows].copy()
            if up >= 0:
                moved[:, up] += 1
            if down >= 0:
                moved[:, down] -= 1
            yield rows, moved


class Trie:
    """Words arranged by frequency vectors. ``children[l]`` are the sorted keys node * base + count of the nodes below level l;
    a node's number is its place among them."""

    def __init__(self, vector: np.ndarray, letters: np.ndarray, offsets: np.ndarray):
        self.base = np.int64(int(vector.max(initial=0)) + 3)
        rows, self.leaf = np.unique(vector, axis=0, return_inverse=True)
        self.leaf = self.leaf.reshape(-1)
        self.children: list[np.ndarray] = []
        node = np.zeros(len(rows), np.int64)
        for level in range(vector.shape[1]):
            keys, node = np.unique(node * self.base + rows[:, level] + 1, return_inverse=True)
            node = node.reshape(-1)
            self.children.append(keys)
        self.size = np.diff(offsets)
        self.leaf_size = np.zeros(len(rows), np.int64)
        self.leaf_size[self.leaf] = self.size
        self.halves = halves(letters, offsets)
        keys = np.concatenate([self.half_key(self.leaf, kind, self.halves[kind]) for kind in range(4)])
        order = np.argsort(keys, kind="stable")
        self.half_keys, self.half_words = keys[order], np.tile(np.arange(len(self.leaf)), 4)[order]

    def half_key(self, leaf: np.ndarray, kind: int, half: np.ndarray) -> np.ndarray:
        return words.joined(half + np.uint64(kind), leaf.astype(np.uint64))

    def search(self, vector: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) of all leaves within the budget of the queries' vectors, block by block, depth first."""
        n = len(vector)
        stack = [(0, np.arange(a, min(a + BLOCK, n)), np.zeros(min(BLOCK, n - a), np.int64), np.zeros(min(BLOCK, n - a), np.int8)) for a in range(0, n, BLOCK)]
        while stack:
            level, query, node, spent = stack.pop()
            if level == len(self.children):
                yield query, node
                continue
            keys, found = self.children[level], []
            want = node * self.base + vector[query, level] + 1
            for step, cost in ((0, 0), (1, 1), (-1, 2)):  # bits of ``spent``: the surplus, the deficit
                able = np.flatnonzero((spent & cost) == 0) if cost else slice(None)
                key = want[able] + step
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == key)
                found.append((query[able][hit], at[hit], spent[able][hit] | np.int8(cost)))
            query, node, spent = (np.concatenate(x) for x in zip(*found, strict=True))
            stack += [(level + 1, query[a : a + BLOCK], node[a : a + BLOCK], spent[a : a + BLOCK]) for a in range(0, len(query), BLOCK)]

    def candidates(self, vector: np.ndarray, size: np.ndarray, half: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) of pairs with vectors within the budget and an equal half."""
        for query, leaf in self.search(vector):
            longer = size[query] - self.leaf_size[leaf]
            for own, other, rows in ((0, 0, longer == 0), (1, 0, longer == 1), (0, 1, longer == -1)):
                rows = np.flatnonzero(rows)
                q, at = query[rows], leaf[rows]
                pairs = []
                for end in (0, 2):  # first half, last half
                    key = self.half_key(at, end + other, half[end + own][q])
                    first = np.searchsorted(self.half_keys, key, "left")
                    n = np.searchsorted(self.half_keys, key, "right") - first
                    pairs.append((np.repeat(q, n), self.half_words[common.ragged_take(np.arange(len(self.half_words)), first, n)]))
                q, w = (np.concatenate(x) for x in zip(*pairs, strict=True))
                both = np.unique(q * len(self.leaf) + w)
                yield both // len(self.leaf), both % len(self.leaf)


def halves(letters: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Fingerprints of each word's first size // 2 and (size - 1) // 2 letters, then of as many last ones."""
    own, start, end = words.mixed(letters.astype(np.uint64) + np.uint64(1)), offsets[:-1], offsets[1:]
    sizes = ((end - start) // 2, (end - start - 1) // 2)
    return [words.range_hashes(own, start, start + k) for k in sizes] + [words.range_hashes(own, end - k, end) for k in sizes]


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a != b and (a[p + 1 :] == b[p:] if len(a) == len(b) + 1 else len(a) == len(b) and a[p + 1 :] == b[p + 1 :])


class Words:
    """Words of a shard as a matrix of letters (0 beyond the end), and those that are too long for it as text."""

    def __init__(self, letters: np.ndarray, offsets: np.ndarray):
        self.letters, self.offsets, self.size = letters, offsets, np.diff(offsets)
        width = min(WIDTH, int(self.size.max(initial=0)))
        self.matrix = np.zeros((len(self.size), width + 1), np.uint8)
        used = np.minimum(self.size, width)
        self.matrix[np.arange(width + 1)[None] < used[:, None]] = common.ragged_take(letters, offsets[:-1], used)

    def word(self, i: int) -> str:
        return self.letters[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("latin-1")

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of words differ by one edit."""
        swap = self.size[a] < self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        out = np.zeros(len(a), bool)
        for x in range(0, len(a), BLOCK):
            i, j = a[x : x + BLOCK], b[x : x + BLOCK]
            long, short = self.matrix[i], self.matrix[j]
            differ = long != short
            replaced = (self.size[i] == self.size[j]) & (differ.sum(axis=1) == 1)
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), long.shape[1])
            shifted = (long[:, 1:] != short[:, :-1]) & (np.arange(long.shape[1] - 1)[None] >= first[:, None])
            out[x : x + BLOCK] = replaced | ((self.size[i] == self.size[j] + 1) & ~shifted.any(axis=1))
        for k in np.flatnonzero(self.size[a] > WIDTH).tolist():
            out[k] = one_edit(self.word(a[k]), self.word(b[k]))
        return out


NEAR = "word string, n_near long, form_n long, form string"


def shard_search(table: np.ndarray, groups: int) -> Callable[[pa.Table], pa.Table]:
    """For a shard's rows (word, n, home): the searched words' near words among those at home, counted, and the best of them."""

    def run(rows: pa.Table) -> pa.Table:
        names = rows.column("word").combine_chunks()
        letters, offsets = letters_of(names)
        vector = vectors(letters, offsets, table, groups).astype(np.int64)
        home = np.flatnonzero(rows.column("home").to_numpy())
        if not len(home):
            return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "form_n": pa.array([], pa.int64()), "form": pa.array([], pa.string())})
        all_words, half = Words(letters, offsets), halves(letters, offsets)
        own = common.ragged_take(letters, offsets[home], all_words.size[home])
        trie = Trie(vector[home], own, np.r_[0, np.cumsum(all_words.size[home])])
        pairs = []
        for q, w in trie.candidates(vector, all_words.size, half):
            w = home[w]
            near = all_words.one_edit(q, w)
            pairs.append((q[near], w[near]))
        q, w = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        n = rows.column("n").to_numpy()
        place = np.empty(len(names), np.int64)  # in code-point order, which is that of UTF-8
        place[np.argsort(np.array(names.to_pylist(), dtype=object))] = np.arange(len(names))
        order = np.lexsort((place[w], -n[w], q))
        q, w = q[order], w[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][: len(q)])
        count = np.diff(np.r_[first, len(q)])
        best = w[first]
        return pa.table({"word": names.take(pa.array(q[first])), "n_near": pa.array(count), "form_n": pa.array(n[best]), "form": names.take(pa.array(best))})

    return run


def near_words(counted: DataFrame, groups: int = GROUPS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, form_n, form): of the words (word, n; each once, of letters up to U+00FF) that have near ones their number and the most frequent of them."""
    spark = counted.sparkSession
    letters = counted.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().filter("letter <> ''")
    table = letter_groups({r["letter"]: r["count"] for r in letters.collect()}, groups)  # as long as the alphabet

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The number of words under each path, batch by batch."""
        for batch in batches:
            vector = vectors(*letters_of(batch.column(0)), table, groups)
            for level in range(1, groups + 1):
                paths, n = np.unique(vector[:, :level], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in paths], pa.binary()), pa.array(n)], ["path", "n"])

    sizes = counted.select("word").mapInArrow(counts, "path binary, n long").groupBy("path").agg(F.sum("n").alias("n"))
    largest = {r.level // 4: r.n for r in sizes.groupBy(F.octet_length("path").alias("level")).agg(F.max("n").alias("n")).collect()}
    levels = next((x for x in range(1, groups) if largest.get(x, 0) <= shard_words), groups)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = vectors(*letters_of(batch.column(0)), table, groups)[:, :levels]
            for k, (rows, paths) in enumerate(reachable(path)):
                shard = pa.array([p.tobytes() for p in paths], pa.binary())
                yield pa.RecordBatch.from_arrays([shard, *(batch.column(i).take(pa.array(rows)) for i in (0, 1)), pa.array(np.full(len(rows), k == 0))], ["shard", "word", "n", "home"])

    rows = counted.select("word", "n").mapInArrow(dealt, "shard binary, word string, n long, home boolean")
    found = rows.groupBy("shard").applyInArrow(lambda t: shard_search(table, groups)(t), NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return common.written(found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"), "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form (word, form): the last form of the chain. Each round doubles the steps taken; a chain is
    short where each form is some times as frequent as the word before it."""
    at = common.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = common.written(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        common.drop(at)
        at = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return at


def variants(counted: DataFrame, times: int = 5, groups: int = GROUPS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all counted words: ``form`` is the most frequent near word if it is at least
    ``times`` as frequent as the word, and ``root`` the last of the forms."""
    counted = common.written(counted.select("word", "n"), "words")
    near = near_words(counted, groups, shard_words)
    joined = counted.join(near, "word", "left")
    use = F.col("form_n") >= times * F.col("n")
    formed = common.written(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(use, F.col("form")).alias("form"), F.when(use, F.col("form_n")).alias("form_n")), "forms")
    common.drop(counted, near)
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
