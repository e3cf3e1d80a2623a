"""Token-id files: canonical length-limited Huffman coding from global counts.

1. Texts are encoded (mapInArrow) and written once as plain ids in the shared folder.
2. Spark sums the count of each id over all documents; the driver sees one row per id of the
   vocabulary and makes the code lengths (package-merge under a length limit).
3. Documents are range-partitioned and sorted by document id, and each partition is packed into
   independent blocks. A block holds its document ids and sizes, the bits (each document starts
   on a byte), and a bit-offset checkpoint every ``STEP`` ids.
4. Reading decodes all stretches between checkpoints of a block in step, by table look-up.

The files need nothing but themselves: ``path``/code holds the id and code length of each used id, from which the
canonical code follows, and ``path``/blocks the blocks. Any later session can read them.

Null text counts as empty: only the end id. Documents with a null id come first; documents
with equal ids are kept, ordered by a hash of their ids (equal ones are interchangeable).

A document is never split: one with more ids than a block holds is a block of its own. Other columns don't matter. An empty table gives files without blocks, which read as no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, token_counts, words

#: ids between checkpoints, bytes of a block's payload, ids that one shard should hold
STEP, BLOCK_BYTES, SHARD_IDS = 512, 1_000_000, 20_000_000


class LibraryEncoder:
    """The tokenizers library applied to the distinct pre-tokens of a slice of texts that weren't seen lately."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.source = file.read()
        spec = json.loads(self.source)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path}: only plain byte-level BPE without normalizer is supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.n_ids = 1 + max([*vocab.values(), *self.special.values()])
        #: bytes that each id stands for; each letter of a byte-level token is one byte
        self.id_bytes = np.zeros(self.n_ids, np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token)
        self.classes = words.char_classes()
        self.dtype = np.dtype("<u2") if self.n_ids <= 1 << 16 else np.dtype("<u4")

        self.recent = words.Recent(self.dtype)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("library", "recent")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"recent": words.Recent(state["dtype"])}

    def encode(self, kinds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each pre-token of the list."""
        if not hasattr(self, "library"):
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.source)
        (found,) = self.library.encode_batch_fast([[w.decode() for w in kinds]], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        cut = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum([len(w) for w in kinds]), "left") + 1
        return ids, np.diff(np.r_[0, cut])

    def ids(self, strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their number for each text)."""
        pieces, owner, found = token_counts.split_special(strings, self.special)
        raw, starts, lens, bounds = token_counts.pretokens(pieces, self.classes)
        at, counts = self.recent.of(raw, starts, lens, self.encode)
        ids = common.ragged_take(self.recent.values, at, counts)
        of_piece = common.sums(counts, bounds)
        extra = np.array([len(x) for x in found], np.int64)
        n = np.bincount(owner, of_piece, len(strings)).astype(np.int64) + extra
        if extra.any():  # special ids go between the pieces of their text
            ends = np.cumsum(of_piece)
            last = np.r_[owner[1:] != owner[:-1], True]
            ids = np.insert(ids, ends[~last], [self.special[s] for x in found for s in x])
        return ids, n


def token_ids(docs: DataFrame, encoder, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): little-endian ids of each text with the end id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder.value
        for batch in batches:
            strings = common.plain_strings(batch.column("text"))
            for a, b in common.text_slices(strings):
                ids, n = enc.ids(strings.slice(a, b - a))
                ids = np.insert(ids, np.cumsum(n), enc.dtype.type(end_id))
                ends = np.r_[0, np.cumsum(n + 1)]
                blob = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((ends * enc.dtype.itemsize).astype(np.int64)), pa.py_buffer(ids.astype(enc.dtype))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(n + 1, pa.int64()), blob.cast(pa.binary())], ["doc_id", "n_tokens", "ids"])

    return common.spread(rows).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_counts(tokens: DataFrame, n_ids: int, dtype: np.dtype) -> dict[int, int]:
    """Count of each id over all documents; at most one row per id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            ids = flat_ids(batch.column("ids"), dtype)[0]
            for a in range(0, len(ids), 1 << 22):
                total += np.bincount(ids[a : a + (1 << 22)], minlength=n_ids)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def flat_ids(blobs: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of a column of id strings, without a copy."""
    blobs = blobs.cast(pa.large_binary())
    _, offsets, data = blobs.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(blobs) + 1, blobs.offset * 8) if len(blobs) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]].view(dtype), (bounds - bounds[0]) // dtype.itemsize


def code_lengths(weights: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge) for weights in ascending order."""
    n = len(weights)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    weights = weights.astype(np.float64)
    leaf_flags, row = [], weights
    for level in range(limit):
        if level:
            pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
            row = np.concatenate([weights, pairs])
        flags = np.arange(len(row)) < n
        order = np.argsort(row, kind="stable")
        row, flags = row[order], flags[order]
        leaf_flags.append(flags)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(leaf_flags):
        leaves = int(flags[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    return lengths


class Code:
    """Canonical prefix code of ids by their code lengths (0: not used)."""

    def __init__(self, length: np.ndarray):
        self.length, self.code = length.astype(np.int64), np.zeros(len(length), np.uint64)
        used = np.flatnonzero(self.length)
        self.limit = max(16, int(self.length.max(initial=1)))
        #: id and length for each value of the next ``limit`` bits
        self.symbols, self.sizes = np.zeros(1 << self.limit, np.uint32), np.ones(1 << self.limit, np.uint8)
        code, before = 0, 0
        for i in used[np.lexsort((used, self.length[used]))].tolist():
            k = int(self.length[i])
            code <<= k - before
            before = k
            self.code[i] = code
            span = slice(code << (self.limit - k), (code + 1) << (self.limit - k))
            self.symbols[span], self.sizes[span] = i, k
            code += 1

    @classmethod
    def of_counts(cls, counts: dict[int, int], n_ids: int) -> Code:
        """The code for these counts; equal counts always give the same one."""
        used = sorted(counts, key=lambda i: (counts[i], i))
        limit = max(16, (len(used) - 1).bit_length() + 2)
        length = np.zeros(n_ids, np.int64)
        length[used] = code_lengths(np.array([counts[i] for i in used], np.int64), limit)
        return cls(length)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Code:
        """The code of files at ``path``: one row for each used id."""
        rows = spark.read.schema(CODE_SCHEMA).parquet(f"{path}/code").collect()
        length = np.zeros(1 + max((r["id"] for r in rows), default=0), np.int64)
        for r in rows:
            length[r["id"]] = r["length"]
        return cls(length)

    def pack(self, ids: np.ndarray, n: np.ndarray) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
        """(bits, byte offsets of the documents, checkpoints of each document in bits)."""
        size = self.length[ids]
        starts = np.r_[0, np.cumsum(n)]
        before = np.cumsum(size) - size
        n_bits = common.sums(size, starts)
        at_byte = np.r_[0, np.cumsum((n_bits + 7) // 8)]
        own = before - np.repeat(np.append(before, 0)[starts[:-1]], n)  # bit offset within the document
        pos = own + np.repeat(at_byte[:-1] * 8, n)
        word, shift = pos >> 6, 64 - (pos & 63) - size
        value, over = self.code[ids], shift < 0
        high = np.where(over, value >> np.maximum(-shift, 0).astype(np.uint64), value << np.maximum(shift, 0).astype(np.uint64))
        out = np.zeros(at_byte[-1] // 8 + 2, np.uint64)
        if len(ids):
            head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[head]] = np.bitwise_or.reduceat(high, head)
            out[word[over] + 1] |= value[over] << (64 + shift[over]).astype(np.uint64)
        marks = [own[a:b:STEP] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        return out.astype(">u8").tobytes(), at_byte, marks

    def unpack(self, payload: bytes, bits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of all stretches, in order; each starts at a bit offset and holds a count of ids."""
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        view = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        pos, left = bits[order].astype(np.int64), counts[order]
        out = np.zeros((int(left[0]) if len(left) else 0, len(left)), np.uint32)
        active = np.searchsorted(-left, -np.arange(len(out)), "left")  # stretches longer than the step
        drop, shift = np.uint32(32 - self.limit), np.uint32(7)
        for step in range(len(out)):
            p = pos[: active[step]]
            peek = (view[p >> 3] << (p.astype(np.uint32) & shift)) >> drop
            out[step, : len(p)] = self.symbols[peek]
            p += self.sizes[peek]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out.T[back][np.arange(len(out)) < counts[:, None]]


BLOCK_SCHEMA = "shard int, block int, n_ids long, doc_ids array<long>, doc_tokens array<int>, checkpoints array<long>, payload binary"
CODE_SCHEMA = "id int, length int"


def write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text) and write the code and the block files to ``path``."""
    spark = docs.sparkSession
    library = LibraryEncoder(tokenizer_path)
    n_ids, dtype = library.n_ids, library.dtype
    plain = common.new_path(spark, "token-ids")
    token_ids(docs, spark.sparkContext.broadcast(library), end_id).write.option("compression", "zstd").parquet(plain)
    tokens = spark.read.schema("doc_id long, n_tokens long, ids binary").parquet(plain)
    counts = id_counts(tokens, n_ids, dtype) or {end_id: 1}
    code = Code.of_counts(counts, n_ids)
    lengths = [(i, int(code.length[i])) for i in sorted(counts)]
    spark.createDataFrame(lengths, CODE_SCHEMA).coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(code)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (document ids, ids, bytes, checkpoints) of consecutive documents
        size = 0

        def block() -> pa.RecordBatch:
            at = np.cumsum([0, *[len(raw) for _, _, raw, _ in held]])
            n = np.concatenate([x[1] for x in held])
            marks = [m + a * 8 for (*_, own), a in zip(held, at.tolist(), strict=False) for m in own]
            rows = {"shard": [shard], "block": [number], "n_ids": [int(n.sum())], "doc_ids": [[i for x in held for i in x[0]]], "doc_tokens": [n], "checkpoints": [np.concatenate(marks)], "payload": [b"".join(x[2] for x in held)]}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], list(rows))

        for batch in batches:
            ids, bounds = flat_ids(batch.column("ids"), dtype)
            doc_ids = batch.column("doc_id").to_pylist()
            at = 0
            while at < len(doc_ids):  # slices of bounded size
                end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES // 2, "right")) - 1)
                n = np.diff(bounds[at : end + 1])
                raw, offsets, marks = shared.value.pack(ids[bounds[at] : bounds[end]], n)
                marks = [m + a * 8 for m, a in zip(marks, offsets.tolist(), strict=False)]
                held.append((doc_ids[at:end], n, raw[: offsets[-1]], marks))
                size += int(offsets[-1])
                if size >= BLOCK_BYTES:
                    yield block()
                    number, held, size = number + 1, [], 0
                at = end
        if held:
            yield block()

    shards = max(spark.sparkContext.defaultParallelism, sum(counts.values()) // SHARD_IDS)
    tie = F.xxhash64("ids")  # so that rows of one id (or none) don't all go to one shard
    ordered = tokens.repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/blocks")
    common.drop_path(spark, plain)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files; ``ids`` on request."""
    files = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    shared = spark.sparkContext.broadcast(Code.load(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n = np.asarray(batch.column("doc_tokens")[row].values, np.int64)
                stretches = (n + STEP - 1) // STEP
                last = np.cumsum(stretches) - 1
                counts = np.full(int(stretches.sum()), STEP, np.int64)
                counts[last] = n - (stretches - 1) * STEP
                marks = np.asarray(batch.column("checkpoints")[row].values, np.int64)
                ids = shared.value.unpack(batch.column("payload")[row].as_py(), marks, counts).astype("<u4")
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                spans = list(zip(((ends - n) * 4).tolist(), (ends * 4).tolist(), strict=True))
                columns = [pa.array([batch.column(c)[row].as_py()] * len(n), pa.int32()) for c in ("shard", "block")]
                columns += [batch.column("doc_ids")[row].values, pa.array(ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64())]
                names = ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(raw[a:b], "<u4").astype(np.int32) for a, b in spans], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    per_block = files.select("shard", "block", "n_ids")
    per_shard = per_block.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row per shard: the only order over everything
    first = per_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    starts = per_block.withColumn("block_start", inside).join(first, "shard").select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base"))
    out = files.mapInArrow(run, "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return out.join(starts, ["shard", "block"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
