"""Near-copies of whole texts: SimHash balls and MinHash bands find candidates, shingle sets verify them.

Two texts are near-copies if ``similarity`` (0.8) of their distinct word shingles (five words; the whole text if it has fewer) are common to both.
The balls of ``simhash`` join texts with fingerprints within two of 64 bits: nearly equal texts, but only part of the near-copies, which differ in 3 to 11 bits
and in more if they are short. So the distinct shingles also give BANDS * ROWS minima under independent hash functions, and texts meet
where a band of ROWS minima is equal. At similarity 0.8 that fails in all bands with a probability of (1 - 0.8 ** ROWS) ** BANDS, below one in
ten thousand, whatever the length or vocabulary of the texts; above 0.8 it is less. Every link is verified by the exact sets.

Exact copies (equal words, by digest) are merged before. Texts that meet in one place form a bucket:

- all pairs of buckets of up to LISTED texts are verified;
- of larger ones each text takes part in its largest bucket first. The bucket is dealt into cells of about CELL texts; a cell compares its texts, the most
  alike by their minima first, and only those that its links haven't joined yet. The most typical text of each cell goes on to
  the next level, until a bucket has one cell;
- where a bucket still has texts of several components, those outside its largest component are compared with all others, cell by cell.

Within a cell, pairs whose minima agree in under ROUGH of all places are passed over (five standard deviations below 0.8: fewer than one in a million of
the pairs at 0.8). No cell is larger than about CELL texts or CELL_SHINGLES shingles (or one text), and no pair is left out for the size of its bucket.

Null text counts as empty. Texts without words are copies of one another. Rows with equal ids but different words are texts of their own; rows without
an id are in no group and stay. Of a group the least id stays, with all rows of that id and these words; other columns pass unchanged. A text is one row, however long.
An empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, components, simhash, words

ROWS, BANDS = 5, 24
LISTED, CELL, CELL_SHINGLES = 8, 256, 2_000_000
ROUGH = 0.62
#: for each minimum an odd multiplier and a mask, from a fixed rule
_RULE = words.mixed(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MASKS, _STEPS = (_RULE[: ROWS * BANDS] >> np.uint64(32)).astype(np.uint32), (_RULE[ROWS * BANDS :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def text_shingles(strings: pa.LargeStringArray, shingle: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(hashes, bounds, digests): fingerprints of all texts' word shingles, repeats included, the n + 1 bounds of the texts in them, and the
    two halves of the digests of each text's words in lower case."""
    raw, offsets = common.byte_view(strings)
    raw = simhash._FOLD[raw]
    starts, lens, bounds = words.byte_words(raw, offsets)
    (h,) = words.word_hashes(raw, starts, lens)
    digests = words.sequence_digests(raw, starts, lens, bounds[:-1], bounds[1:])
    n = np.diff(bounds)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = common.ragged_take(np.arange(len(h)), bounds[:-1], count)
    last = np.minimum(first + shingle, np.repeat(bounds[1:], count))
    return words.range_hashes(h, first, last), np.r_[0, np.cumsum(count)].astype(np.int64), digests


def minima(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least value of each text's shingles under each hash function; a row of the largest number for texts without shingles."""
    out = np.full((len(bounds) - 1, ROWS * BANDS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        x, at = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32), bounds[full]
        for k in range(ROWS * BANDS):
            out[full, k] = np.minimum.reduceat((x ^ _MASKS[k]) * _STEPS[k], at)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each text and band."""
    parts = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = words.joined(key, parts[:, :, k])
    return key.view(np.int64)


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The SimHash fingerprint of each text's shingles."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    prints = np.zeros(len(n), np.uint64)
    for a in range(0, len(n), 256):
        b = min(a + 256, len(n))
        part = octets[bounds[a] : bounds[b]].astype(np.int64) + np.arange(8) * 256 + ((owner[bounds[a] : bounds[b]] - a) * 2048)[:, None]
        seen = np.bincount(part.ravel(), minlength=(b - a) * 2048).reshape(b - a, 8, 256)
        prints[a:b] = np.packbits((seen @ simhash._BITS).reshape(b - a, 64) * 2 > n[a:b, None], axis=1, bitorder="little").view("<u8").ravel()
    return prints.view(np.int64)


def text_mark() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, mark, d1, d2, n, fp, keys): hash of the text, digest of its words, number of shingles, fingerprint and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column("text"))
            for a, b in common.text_slices(strings):
                hashes, bounds, (d1, d2) = text_shingles(strings.slice(a, b - a), shingle)
                keys = band_keys(minima(hashes, bounds))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                columns = [pa.array(d1), pa.array(d2), pa.array(np.diff(bounds)), pa.array(majority(hashes, bounds)), listed]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_id", "mark")), *columns], ["doc_id", "mark", "d1", "d2", "n", "fp", "keys"])

    return common.spread(docs.withColumn("mark", text_mark())).mapInArrow(run, "doc_id long, mark long, d1 long, d2 long, n long, fp long, keys array<long>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, d1, d2, h, sketch): each text's distinct shingles in order, and a byte of each of its minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column("text"))
            for a, b in common.text_slices(strings):
                hashes, bounds, (d1, d2) = text_shingles(strings.slice(a, b - a), shingle)
                sketch = minima(hashes, bounds).astype(np.uint8)
                own = [np.unique(hashes[x:y]).view(np.int64) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [pa.array(d1), pa.array(d2), pa.array(own, pa.list_(pa.int64())), pa.array([x.tobytes() for x in sketch], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], ["doc_id", "d1", "d2", "h", "sketch"])

    return docs.mapInArrow(run, "doc_id long, d1 long, d2 long, h array<long>, sketch binary")


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have at least this share of their union in common."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= similarity * (len(x) + len(y) - shared) - 1e-9


class Cell:
    """Texts of a bucket that are compared in one task."""

    def __init__(self, table: pa.Table):
        self.node = table.column("node").to_numpy()
        sets = table.column("h").combine_chunks()
        at, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
        self.sets = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, ROWS * BANDS)

    def alike(self, other: Cell) -> np.ndarray:
        """Share of equal minima of all pairs."""
        out = np.zeros((len(self.node), len(other.node)), np.float32)
        for k in range(ROWS * BANDS):
            out += self.sketch[:, k, None] == other.sketch[None, :, k]
        return out / (ROWS * BANDS)


def links_between(left: Cell, right: Cell, alike: np.ndarray, of_left: list[int], of_right: list[int], similarity: float) -> list[tuple[int, int]]:
    """Verified links of texts whose components (numbers) aren't joined yet, the most alike first."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    i, j = np.nonzero(alike >= ROUGH)
    order = np.argsort(-alike[i, j], kind="stable")
    found = []
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        x, y = root(of_left[a]), root(of_right[b])
        if x != y and similar(left.sets[a], right.sets[b], similarity):
            up[max(x, y)] = min(x, y)
            found.append((int(left.node[a]), int(right.node[b])))
    return found


LINKS = "a long, b long"


def _link_table(found: list[tuple[int, int]], **more: list) -> pa.Table:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), **more})


def groups(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """(doc_id, mark, component_id) of all rows with an id: component_id is the least id that copies and verified links reach; ``mark`` tells
    texts of one id apart."""
    docs = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = common.written(_signed(docs, shingle), "signatures")
    heads = signed.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
    heads = common.written(heads.select(F.monotonically_increasing_id().alias("node"), "*"), "heads")
    repeated = not signed.groupBy("doc_id").count().filter("count > 1").isEmpty()
    classes = components.components(_all_links(heads, docs, repeated, similarity, shingle))
    joined = heads.select("node", "d1", "d2", "doc_id").join(classes, "node", "left").select("d1", "d2", "doc_id", F.coalesce("component", "node").alias("component"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    member = joined.select("d1", "d2", "component").join(least, "component").select("d1", "d2", "component_id")
    return signed.select("doc_id", "mark", "d1", "d2").join(member, ["d1", "d2"]).select("doc_id", "mark", "component_id")


def _all_links(heads: DataFrame, docs: DataFrame, repeated: bool, similarity: float, shingle: int) -> DataFrame:
    full = heads.filter("n > 0")
    prints = full.groupBy("fp").agg(F.min("node").alias("node"))
    near = simhash.ball_links(prints.select("fp"))
    near = near.join(prints.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(prints.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b")
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    # equal fingerprints are a bucket as well; several bands often have the same texts in a bucket, and one of these is enough
    met = full.select("node", "n", F.explode(F.concat("keys", F.array(F.xxhash64("fp")))).alias("key"))
    size = met.groupBy("key").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"), F.expr("bit_xor(xxhash64(node))").alias("mark"), F.min("node").alias("least")).filter("texts > 1")
    size = size.groupBy("texts", "mark", "least").agg(F.min("key").alias("key"), F.max("shingles").alias("shingles")).select("key", "texts", "shingles")
    buckets = common.written(met.select("key", "node").join(size, "key"), "buckets")
    listed = buckets.filter(F.col("texts") <= LISTED).groupBy("key").agg(F.array_sort(F.collect_list("node")).alias("m"))  # LISTED at most
    later = F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, LISTED), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = listed.select(F.explode(F.flatten(later)).alias("p")).select("p.a", "p.b")
    pairs = common.written(pairs.union(near).filter("a <> b").distinct(), "pairs")
    large = buckets.filter(F.col("texts") > LISTED)

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(large.select("node")).distinct()
    wanted = common.written(wanted.join(heads.select("node", "doc_id", "d1", "d2"), "node"), "wanted")
    texts = docs.join(common.small(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    # a text of an id and a digest counts once, however often it is there
    sets = _sets(texts, shingle).join(wanted, ["doc_id", "d1", "d2"]).select("node", "h", "sketch")
    sets = common.written(sets.dropDuplicates(["node"]) if repeated else sets, "shingles")

    links = common.written(_verified(pairs, sets, similarity), "links")
    common.drop(pairs, wanted)
    if not large.isEmpty():
        links = links.union(_clustered(large, sets, similarity))
        links = common.written(links.union(_between(large, sets, components.components(links), similarity)), "links")
    common.drop(buckets, sets)
    return links


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(*(np.asarray(batch.column(c)[i].values) for c in ("x", "y")), similarity) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("h").alias("x")), "a").filter(F.size("x") > 0)
    both = both.join(sets.select(F.col("node").alias("b"), F.col("h").alias("y")), "b")
    both = both.filter(F.least(F.size("x"), F.size("y")) >= similarity * F.greatest(F.size("x"), F.size("y")) - 1e-9)
    return both.select("a", "b", "x", "y").mapInArrow(verify, LINKS)


def _cells(texts: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(texts) / CELL), F.ceil(F.col(shingles) / CELL_SHINGLES), F.lit(1)).cast("int")


def _clustered(large: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links within the cells of each text's largest bucket, and of the cells' typical texts level by level."""

    def cluster(table: pa.Table) -> pa.Table:
        cell = Cell(table)
        alike = cell.alike(cell)
        typical = int(cell.node[int(alike.sum(axis=1).argmax())])
        own = list(range(len(cell.node)))
        alike[np.tril_indices(len(own))] = 0
        found = links_between(cell, cell, alike, own, own, similarity)
        key = table.column("key")[0].as_py()
        out = _link_table([*found, (typical, typical)])
        return out.append_column("key", pa.array([key] * out.num_rows, pa.int64()))

    rows = large.groupBy("node").agg(F.max_by(F.struct("key", "shingles"), F.struct("texts", "key")).alias("x")).select("node", "x.key", "x.shingles")
    links, level = None, 0
    while True:
        # of the texts that are here, which may be fewer than the bucket's
        sizes = rows.groupBy("key").agg(F.count("*").alias("texts"), F.max("shingles").alias("shingles"))
        dealt = rows.drop("shingles").join(sizes, "key").withColumn("cells", _cells("texts", "shingles"))
        dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("node", F.lit(level)), F.col("cells")))
        found = dealt.join(sets, "node").groupBy("key", "cell").applyInArrow(cluster, f"{LINKS}, key long")
        found = common.written(found, "cells")
        links = found.filter("a <> b").select("a", "b") if links is None else links.union(found.filter("a <> b").select("a", "b"))
        typical = found.filter("a = b").select(F.col("a").alias("node"), "key")
        more = typical.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        if more.isEmpty():
            return links
        rows, level = typical.join(more.select("key"), "key").withColumn("shingles", F.lit(0).cast("long")), level + 1


def _between(large: DataFrame, sets: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Links between the components of each bucket: the texts outside its largest one with all others."""
    known = large.join(classes, "node", "left").select("key", "node", "texts", "shingles", F.coalesce("component", "node").alias("component"))
    known = common.written(known, "members")
    count = known.groupBy("key", "component").agg(F.count("*").alias("k"), F.first("texts").alias("texts"), F.first("shingles").alias("shingles"))
    mixed = count.groupBy("key").agg(F.max_by("component", F.struct("k", "component")).alias("largest"), F.max("k").alias("k"), F.first("texts").alias("texts"), F.first("shingles").alias("shingles")).filter("k < texts")
    mixed = mixed.select("key", "largest", _cells("texts", "shingles").alias("cols"), F.greatest(F.ceil((F.col("texts") - F.col("k")) / F.col("texts") * _cells("texts", "shingles")), F.lit(1)).cast("int").alias("rows"))
    rest = known.select("key", "node", "component").join(mixed, "key")

    def dealt(frame: DataFrame, own: str, other: str, salt: int) -> DataFrame:
        each = frame.withColumn(f"at_{own}", F.pmod(F.xxhash64("node", F.lit(salt)), F.col(own)).cast("int"))
        each = each.select("key", "node", "component", f"at_{own}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"at_{other}"))
        found = each.join(sets, "node")
        return found.select(*[F.col(c).alias(c) for c in found.columns])  # both sides come from one table

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _link_table([])
        x, y = Cell(left), Cell(right)
        return _link_table(links_between(x, y, x.alike(y), left.column("component").to_pylist(), right.column("component").to_pylist(), similarity))

    outside = dealt(rest.filter("component <> largest"), "rows", "cols", 11)
    every = dealt(rest.drop("largest"), "cols", "rows", 12)
    return outside.groupBy("key", "at_rows", "at_cols").cogroup(every.groupBy("key", "at_rows", "at_cols")).applyInArrow(compare, LINKS)


def without_copies(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those with its least id, and rows without an id."""
    gone = groups(docs, similarity, shingle).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    gone = common.small(common.written(gone, "gone"))
    same = (F.col("d.doc_id").cast("long") == F.col("g.gone_id")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("g.gone_mark"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti")
