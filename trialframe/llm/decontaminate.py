"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contaminated by a document that holds at least ``threshold`` of the item's
distinct word shingles. Signatures of whole documents would drown a 20-shingle item in a
20,000-word document, so the search is asymmetric, and its parameters come from the item's
size class (powers of two). Each item keeps the least hashes of its shingles under one random
order (a bottom-m MinHash sketch); m is one more than the number of shingles that an item of its
size may lack, so at least one sketch value of every contained item is among the
document's shingle hashes: no contained item is missed, at any document length. Hashes above the
largest sketch value of all classes are dropped before the look-up. Each collision is verified by
exact containment of word sequences over the whole document.

Words are runs of characters other than ASCII blanks and punctuation, in lower case. An item of
fewer words than a shingle is one shingle, its whole sequence. Items without words and null
texts match nothing. The items are indexed in blocks of bounded size (BLOCK_BYTES of distinct items), each sent to the executors
once and searched in all documents; documents are never shuffled. A benchmark is far smaller than the corpus; one of many blocks costs a pass
over the documents for each.

Rows with null or equal ids are searched like others and give rows of their own; ``clean`` drops all rows of an id that holds an item, null ids as one id. A document is
one cell and one slice, however long. Without documents or without items there are no rows, and nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words

SEPARATORS = words.BLANKS | words.separators(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
#: bytes of item text in one block
BLOCK_BYTES = 16_000_000


def slice_words(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lens, bounds) of the words of lower-case texts."""
    raw, offsets = common.byte_view(pc.utf8_lower(strings))
    return raw, *words.byte_words(raw, offsets, SEPARATORS)


def sequences(raw: bytes, starts: list[int], lens: list[int], width: int) -> set[bytes]:
    """The distinct word sequences of one text, words joined by blanks."""
    found = [raw[a : a + n] for a, n in zip(starts, lens, strict=True)]
    return {b" ".join(found[i : i + width]) for i in range(len(found) - width + 1)}


class ItemIndex:
    """Sketches and words of one block of items, as flat arrays: some five bytes for each byte of text."""

    #: exact shingle sets of recently met items that a worker keeps
    KEPT = 1000

    def __init__(self, ids: list[int], texts: list[str], times: list[int], shingle: int, threshold: float):
        self.ids, self.times = ids, times
        raw, starts, lens, bounds = slice_words(common.plain_strings(pa.array(texts, pa.string())))
        self.data, self.starts, self.lens, self.bounds = raw.tobytes(), starts.astype(np.uint32), lens.astype(np.uint32), bounds
        self.width = np.minimum(shingle, np.diff(bounds))
        (hashes,) = words.word_hashes(raw, starts, lens)
        sketches: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for i, (a, b, width) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), self.width.tolist(), strict=True)):
            if not width:
                continue
            sketch = np.unique(words.window_hashes(hashes[a:b], width))
            # least hashes, as many as the largest item of this size class may lack, and one more
            top = (1 << len(sketch).bit_length()) - 1
            sketch = sketch[: top - ceil(threshold * top) + 1]
            sketches.setdefault(width, []).append(sketch)
            owners.setdefault(width, []).append(np.full(len(sketch), i, np.uint32))
        #: for each width: the probe hashes in order, where the items of each begin, these items, and a bit filter on the low bits
        self.probes = {}
        for width in sketches:
            every, owner = np.concatenate(sketches[width]), np.concatenate(owners[width])
            order = np.argsort(every, kind="stable")
            keys, first = np.unique(every[order], return_index=True)
            seen = np.zeros(1 << 20, bool)
            seen[keys & np.uint64((1 << 20) - 1)] = True
            self.probes[width] = (keys, np.append(first, len(order)), owner[order], seen)
        self.exact: dict[int, set[bytes]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"exact": {}}

    def shingles(self, i: int) -> set[bytes]:
        """The distinct word sequences of an item."""
        found = self.exact.get(i)
        if found is None:
            if len(self.exact) >= self.KEPT:
                self.exact.clear()
            own = slice(self.bounds[i], self.bounds[i + 1])
            found = self.exact[i] = sequences(self.data, self.starts[own].tolist(), self.lens[own].tolist(), int(self.width[i]))
        return found

    def search(self, strings: pa.LargeStringArray, threshold: float) -> list[tuple[int, int, int, int, int]]:
        """(text number, item_id, times, shingles held, shingles of the item) of each contained item."""
        raw, starts, lens, bounds = slice_words(strings)
        (hashes,) = words.word_hashes(raw, starts, lens)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        pairs = set()
        for width, (keys, first, items, seen) in self.probes.items():
            h = words.window_hashes(hashes, width)
            near = np.flatnonzero((h <= keys[-1]) & seen[h & np.uint64((1 << 20) - 1)])
            near = near[owner[near] == owner[near + width - 1]]
            at = np.minimum(np.searchsorted(keys, h[near]), len(keys) - 1)
            hit = keys[at] == h[near]
            for text, k in set(zip(owner[near[hit]].tolist(), at[hit].tolist(), strict=True)):
                pairs.update((text, i) for i in items[first[k] : first[k + 1]].tolist())
        out, held = [], {}
        data = raw.tobytes() if pairs else b""
        for text, i in sorted(pairs):
            width, exact = int(self.width[i]), self.shingles(i)
            if (text, width) not in held:
                a, b = bounds[text], bounds[text + 1]
                held = {(text, width): sequences(data, starts[a:b].tolist(), lens[a:b].tolist(), width)} | {k: v for k, v in held.items() if k[0] == text}
            shared = len(exact & held[text, width])
            if shared >= threshold * len(exact):
                out.append((text, self.ids[i], self.times[i], shared, len(exact)))
        return out


def leaks(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of all documents that hold an item.

    ``docs`` (doc_id, text), ``items`` (item_id, text). Rows with equal ids and texts give one row each; repeats of an
    item are indexed once.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    n_bytes = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_blocks = -(-n_bytes // BLOCK_BYTES) or 1
    rows = common.spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    schema = "doc_id long, item_id long, times long, n_shared long, n_shingles long"
    found = []
    for block in range(n_blocks):
        own = items if n_blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        listed = own.toArrow()
        index = spark.sparkContext.broadcast(ItemIndex(*(listed.column(c).to_pylist() for c in ("item_id", "text", "times")), shingle, threshold))
        del listed

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                strings = common.plain_strings(batch.column("text"))
                for a, b in common.text_slices(strings):
                    hits = index.value.search(strings.slice(a, b - a), threshold)
                    if hits:
                        text, *rest = (pa.array(x, pa.int64()) for x in zip(*hits, strict=True))
                        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a).take(text), *rest], ["doc_id", "item_id", "times", "n_shared", "n_shingles"])

        found.append(rows.mapInArrow(run, schema))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth")
    every = reduce(DataFrame.union, found).select("doc_id", "item_id", "n_shared", "n_shingles", each).drop("nth")
    return every.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose document holds no item."""
    hit = common.small(common.written(leaks(docs, items, shingle, threshold).select("doc_id").distinct(), "leaks"))
    null_hit = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id"))
    return docs.alias("d").join(hit.alias("h"), null_hit, "left_anti").select("d.*")
