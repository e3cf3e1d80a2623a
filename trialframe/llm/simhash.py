"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has 64 bits: the majority of the XXH64 bits of its word shingles. Two
fingerprints that differ in at most two bits have a common value within one bit of both, so
each distinct fingerprint emits itself and its 64 one-bit variants, and the rows are grouped by
variant. A group holds at most 65 fingerprints, one for each flipped bit, so it is kept as one
bit map: the group size is bounded whatever the data are, and equal fingerprints were merged
before. Groups give links from their least fingerprint to the others (checked by bit count),
and components of the links are found by alternating stars.

Null text counts as empty; texts without words have fingerprint zero and link like any other.
Rows with equal ids stay rows of their own.

A class of rows with null ids only has a null component. Columns other than doc_id and text are left out. A text is one cell and one slice, however long. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components, words

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def slice_fingerprints(strings: pa.LargeStringArray, shingle: int, seed: int) -> np.ndarray:
    """Fingerprint of each text, unsigned."""
    raw, offsets = common.byte_view(strings)
    starts, lens, bounds = words.byte_words(raw, offsets)
    n_words = np.diff(bounds)
    # words in lower case, each followed by one blank
    flat = common.ragged_take(_FOLD[np.append(raw, 0)], starts, lens + 1)
    ends = np.cumsum(lens + 1) - 1
    flat[ends] = 0x20
    begins = ends - lens
    # shingles: those whose last word is in the same text, or the whole text if it is shorter
    n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    first = common.ragged_take(np.arange(len(starts)), bounds[:-1], n_shingles)
    owner = np.repeat(np.arange(len(n_words)), n_shingles)
    last = np.minimum(first + shingle, bounds[1:][owner]) - 1
    data, hashed = flat.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begins[first].tolist(), ends[last].tolist(), strict=True)
    h = np.fromiter((hashed(data[a:b], seed) for a, b in spans), np.uint64, len(first))
    # count set bits by way of byte values: one table of 8 x 256 counters for each text
    prints = np.zeros(len(n_words), np.uint64)
    octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    bound = np.r_[0, np.cumsum(n_shingles)]
    for a in range(0, len(n_words), 256):
        b = min(a + 256, len(n_words))
        part = octets[bound[a] : bound[b]].astype(np.int64) + (np.arange(8) * 256) + ((owner[bound[a] : bound[b]] - a) * 2048)[:, None]
        seen = np.bincount(part.ravel(), minlength=(b - a) * 2048).reshape(b - a, 8, 256)
        set_bits = (seen @ _BITS).reshape(b - a, 64)
        major = set_bits * 2 > n_shingles[a:b, None]
        prints[a:b] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return prints


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column("text"))
            for a, b in common.text_slices(strings):
                fp = slice_fingerprints(strings.slice(a, b - a), shingle, seed)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return common.spread(rows).mapInArrow(run, "doc_id long, fp long")


def ball_links(prints: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints of at most two differing bits.

    Not all of them: within a group of fingerprints around one variant, the least is linked to
    each other one, which joins the same components.
    """
    flips = F.array(F.lit(0), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)) for b in range(64)])
    each = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small as it is, the table becomes 65 times as large
    variants = prints.select("fp").distinct().repartition(each, F.xxhash64("fp")).select("fp", F.explode(flips).alias("flip"))
    variants = variants.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "flip")
    groups = variants.groupBy("variant").agg(F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("own"))
    groups = groups.filter(F.bit_count("flips") + F.col("own").cast("int") > 1)
    flipped = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("flips"), b) == 1)
    members = F.transform(flipped, lambda b: F.col("variant").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    members = F.concat(members, F.when(F.col("own"), F.array("variant")).otherwise(F.array().cast("array<bigint>")))
    links = groups.select(members.alias("m")).select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
    return links.filter("a <> b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id that links reach."""
    prints = common.written(fingerprints(docs, shingle, seed), "fingerprints")
    classes = components.components(ball_links(prints)).withColumnRenamed("node", "fp")
    heads = prints.groupBy("fp").agg(F.min("doc_id").alias("head")).join(classes, "fp", "left")
    heads = heads.select("fp", "head", F.coalesce("component", "fp").alias("component"))
    least = heads.groupBy("component").agg(F.min("head").alias("component_id"))
    of_print = heads.join(least, "component").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")
