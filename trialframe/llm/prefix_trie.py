"""Prefix trie of conversations by vertical bitmaps.

Every distinct sequence of first d turns (role, text) is a node of depth d. Conversations are cut into shards of SHARD consecutive
ids. A shard indexes (position, turn) to the bitset of its conversations that have this turn there. A depth-first search starts at the root with all of them: the
posting of a turn at the next position, intersected with a node's bitset, is a child; what is left of the bitset without further turns are
the node's ends. Popcounts are the members.

A node's key is a digest of its path, so the shards' nodes meet by key: members, least ids and leaf flags are aggregated, brought back to the
shards, and each shard adds up its subtrees, where a node counts only in the shard of its least member (all its ancestors are there as well). The sums of the shards
are each node's sums. So a first turn that a third of all conversations share has at most one row for each shard, whatever the
depth or the width of the trie; no conversation's text is read twice or compared as text.

Turns are ordered by ``turn`` (null first), equal ones by role and text; null role or text is empty. Rows without a conversation id
are left out. Repeated rows are repeated turns; other columns don't matter. Turns are told apart by SHA-256 of role and text, of which 16 bytes are kept. An empty
table has no nodes. One conversation's turns are sorted in one task, without their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: conversations of a shard, a power of two
SHARD = 4096
#: key of the node without turns
ROOT = hashlib.blake2b(b"", digest_size=16).digest()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, n_words): the turns of each conversation in order, from 0, with digests in place of texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(both, 256)), 1, 16)
    n_words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("turn_key"), n_words.alias("n_words"))
    # role and text decide between equal turns only
    alike = F.count("*").over(Window.partitionBy("conv_id", "turn")) > 1
    tied = rows.groupBy("conv_id", "turn").count().filter("count > 1")
    if tied.isEmpty():
        plain = rows.drop("role", "text")
        order = ["turn"]
    else:
        plain, order = rows.withColumns({"role": F.when(alike, F.col("role")), "text": F.when(alike, F.col("text"))}), ["turn", "role", "text"]
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(*[F.asc_nulls_first(c) for c in order])) - 1
    return plain.select("conv_id", pos.alias("pos"), "turn_key", "n_words")


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): all ids, and the turns of the rebuilt conversations: the first h of the family's first conversation, c - c % family,
    then the conversation's own after its first h; h is the CRC-32 of the decimal id modulo ``heads``."""
    own = common.written(numbered_turns(turns), "turns")
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    ids = own.groupBy("conv_id").agg(F.count("*").alias("size")).select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("first"))
    ids = common.written(ids, "conversations")
    # at most heads - 1 turns of each family's first conversation, for fewer than 2 * family members
    opening = own.filter((F.col("conv_id") % family == 0) & (F.col("pos") < heads - 1))
    opening = opening.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "turn_key", "n_words"))).alias("opening")).withColumnRenamed("conv_id", "first")
    given = ids.join(opening, "first", "left").select("conv_id", "h", F.slice(F.coalesce("opening", F.array().cast("array<struct<pos:int,turn_key:binary,n_words:bigint>>")), 1, F.col("h")).alias("given"))
    given = common.written(given, "openings")
    borrowed = given.select("conv_id", F.explode("given").alias("t")).select("conv_id", "t.*")
    rest = own.join(given.select("conv_id", "h", F.size("given").alias("had")), "conv_id").filter("pos >= h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("had")).cast("int").alias("pos"), "turn_key", "n_words")
    return ids.select("conv_id"), borrowed.union(rest)


def shard_of(conv_id: Column, size: int) -> Column:
    return F.shiftright(conv_id, size.bit_length() - 1)


class Shard:
    """Postings of one shard and the depth-first search over them. Conversations are bits; ``low`` is the id of bit 0."""

    def __init__(self, low: int, bits: list[int], pos: list[int], turn: list[bytes], n_words: list[int]):
        self.low, self.all, self.postings, self.words = low, 0, {}, {}
        self.turns: dict[int, list[bytes]] = {}
        for bit, p, key, n in sorted(zip(bits, pos, turn, n_words, strict=True), key=lambda x: (x[0], x[1])):
            self.all |= 1 << bit
            own = self.turns.setdefault(bit, [])
            if p >= 0:  # -1: the conversation itself
                own.append(key)
                self.postings[p, key] = self.postings.get((p, key), 0) | 1 << bit
                self.words[key] = n

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int, list[int], int]]:
        """(key, parent, parent's number, depth, members, least id, ends, words of the last turn) of all nodes, parents first."""
        stack: list[tuple[bytes, bytes | None, int, int, int, int]] = [(ROOT, None, -1, 0, self.all, 0)]
        number = 0
        while stack:
            key, parent, above, depth, members, n_words = stack.pop()
            ends, rest, children = [], members, []
            while rest:
                bit = (rest & -rest).bit_length() - 1
                own = self.turns[bit]
                if len(own) == depth:
                    ends.append(self.low + bit)
                    rest &= rest - 1
                    continue
                turn = own[depth]
                child = members & self.postings[depth, turn]
                rest &= ~child
                children.append((hashlib.blake2b(key + turn, digest_size=16).digest(), key, number, depth + 1, child, self.words[turn]))
            yield key, parent, above, depth, members.bit_count(), self.low + (members & -members).bit_length() - 1, ends, n_words
            stack += reversed(children)
            number += 1


LOCAL = "shard long, number int, above int, key binary, depth int, n_convs long, conv_id long, n_words long, inner boolean, ends array<long>"


def _search(table: pa.Table, size: int) -> pa.Table:
    shard = table.column("shard")[0].as_py()
    low = shard * size
    bits = (table.column("conv_id").to_numpy() - low).tolist()
    index = Shard(low, bits, table.column("pos").to_pylist(), table.column("turn_key").to_pylist(), table.column("n_words").to_pylist())
    key, _, above, depth, n, least, ends, n_words = zip(*index.nodes(), strict=True)
    inner = np.zeros(len(key), bool)
    up = np.array(above)
    inner[up[up >= 0]] = True
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
    columns = ([shard] * len(key), range(len(key)), above, key, depth, n, least, n_words, inner.tolist(), ends)
    names = ["shard", "number", "above", "key", "depth", "n_convs", "conv_id", "n_words", "inner", "ends"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


SUMS = "key binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _subtrees(table: pa.Table, size: int) -> pa.Table:
    """Each node's sums over its subtree in this shard; the other columns are there at its home only."""
    table = table.sort_by("number")
    shard = table.column("shard")[0].as_py()
    above, conv, n = (table.column(c).to_numpy() for c in ("above", "all_conv_id", "all_convs"))
    home = conv >> (size.bit_length() - 1) == shard
    leaf = home & ~table.column("all_inner").to_numpy(zero_copy_only=False)
    saved = np.where(home, (n - 1) * table.column("n_words").to_numpy(), 0)
    leaves, children = leaf.astype(np.int64), np.zeros(len(n), np.int64)
    np.add.at(children, above[1:], home[1:])
    depth = table.column("depth").to_numpy()
    # nodes are in depth-first order: a subtree is the stretch up to the next node that is no deeper
    end, open_ = np.full(len(n), len(n)), []
    for i, d in enumerate(depth.tolist()):
        while open_ and depth[open_[-1]] >= d:
            end[open_.pop()] = i
        open_.append(i)
    total = [np.r_[0, np.cumsum(x)] for x in (leaves, saved)]
    at = np.arange(len(n))
    parent = pa.array(conv[np.maximum(above, 0)], mask=(above < 0) | ~home)
    columns = [table.column("key").combine_chunks(), table.column("depth").combine_chunks(), pa.array(conv, mask=~home), parent, pa.array(n, mask=~home), pa.array(children), *(pa.array(t[end] - t[at]) for t in total)]
    return pa.table(columns, ["key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])


def ends_digests(local: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids that end at each node, ascending and joined by commas, as a stream over the shards' lists in order."""
    rows = local.filter(F.size("ends") > 0).select("key", "shard", F.array_join("ends", ",").alias("ends"))
    rows = rows.repartition("key").sortWithinPartitions("key", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for own, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.string()))], ["key", "ends_sha256"])
                out = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    return rows.mapInArrow(run, "key binary, ends_sha256 string")


def local_tries(conversations: DataFrame, turns: DataFrame, size: int = SHARD) -> DataFrame:
    """The nodes of all shards, in the schema ``LOCAL``: ``number`` counts a shard's nodes depth first, ``above`` is the parent's."""
    alone = conversations.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("n_words"))
    rows = alone.union(turns.select("conv_id", "pos", "turn_key", "n_words")).withColumn("shard", shard_of(F.col("conv_id"), size))
    return common.written(rows.groupBy("shard").applyInArrow(lambda t: _search(t, size), LOCAL), "tries")


def trie(conversations: DataFrame, turns: DataFrame, size: int = SHARD) -> DataFrame:
    """(key, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the nodes of all ``conversations`` (conv_id, each once) with
    the ``turns`` (conv_id, pos, turn_key, n_words; pos from 0 without gaps).
    ``size`` is a power of two, the conversations of a shard. conv_id is the node's least member; with ``depth`` it tells where its last turn stands."""
    local = local_tries(conversations, turns, size)
    every = local.groupBy("key").agg(F.sum("n_convs").alias("all_convs"), F.min("conv_id").alias("all_conv_id"), F.bool_or("inner").alias("all_inner"))
    known = local.select("shard", "number", "above", "key", "depth", "n_words").join(every, "key")
    sums = known.groupBy("shard").applyInArrow(lambda t: _subtrees(t, size), SUMS)
    node = sums.groupBy("key").agg(F.max("depth").alias("depth"), *[F.max(c).alias(c) for c in ("conv_id", "parent_conv_id", "n_convs")], *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return node.join(ends_digests(local), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))


def prefix_nodes(turns: DataFrame, size: int = SHARD) -> DataFrame:
    """The query's columns for all nodes of the rebuilt conversations."""
    found = trie(*rebuilt(turns), size)
    columns = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    return found.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", *columns, "ends_sha256")
