"""Removal of long repeated word sequences by recompression.

A word covered by a window of ``window`` words that also starts earlier in the corpus is removed.

*Naming.* A text is a row of symbols, at first its words. A round names each run of equal
symbols, then each pair of a "left" and a "right" symbol, where a symbol's side in a round comes
from its name. A name is a fingerprint of what it stands for, so it is the same in all documents
without any exchange. With each symbol goes the stretch of words that decided it: its own words
and as much of its surroundings as its rounds looked at. Wherever that stretch occurs again, the
same symbol occurs again. These are the interior symbols: if a window occurs twice, every symbol
whose deciding stretch lies in the window occurs in both places.

*Anchors.* Each window picks the least-named interior symbol of the highest level that has one
(words are level 0, so there always is one). The choice depends on the window's words alone. Spark
counts anchors over the corpus: only windows whose anchor occurs twice can repeat.

*Verification.* Those windows are grouped by the 128-bit BLAKE2 digest of their words, joined by blanks, and each
that isn't the first of its group marks its words for removal. So equal names or anchors of different words cost a
look and change nothing.

Skew: exact copies of a text (equal digests of all its words) are set aside first: all but the first lose everything. Anchor
counts are aggregated before the shuffle, and the anchors' join is one that adaptive execution
splits. A task sends each distinct window once, so that a group has at most one row per task
and flush. No group of occurrences is ever gathered.

Null text has no words: it counts 0 and keeps the empty text. Rows with equal or null ids are put
in order of id (null first) and text, and count as documents one after another.

Other columns don't matter. A text is one cell and one slice, however long. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, words

_U = np.uint64
#: candidate windows that a task holds before it sends them on
FLUSH = 2_000_000


class Level:
    """Symbols of one level: names, their words [start, end), and the words [da, db] that decided them.

    A stretch that reaches past the text's bounds is given one word too many on that side, which
    no window of the text holds.
    """

    def __init__(self, name: np.ndarray, start: np.ndarray, end: np.ndarray, da: np.ndarray, db: np.ndarray, doc: np.ndarray):
        self.name, self.start, self.end, self.da, self.db, self.doc = name, start, end, da, db, doc

    def take(self, at: np.ndarray) -> Level:
        return Level(*(x[at] for x in (self.name, self.start, self.end, self.da, self.db, self.doc)))


def _neighbours(level: Level, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether a left and a right neighbour exist, and where the neighbours' stretches reach to."""
    left = np.zeros(len(level.name), bool)
    left[1:] = level.doc[1:] == level.doc[:-1]
    right = np.append(left[1:], False)
    far_left = np.where(left, np.append(0, level.da[:-1]), bounds[level.doc] - 1)
    far_right = np.where(right, np.append(level.db[1:], 0), bounds[level.doc + 1])
    return left, right, far_left, far_right


def name_runs(level: Level, tokens: np.ndarray, bounds: np.ndarray, number: int) -> Level:
    """Each run of equal symbols becomes one symbol."""
    left, right, far_left, far_right = _neighbours(level, bounds)
    new = np.ones(len(level.name), bool)
    new[1:] = (level.name[1:] != level.name[:-1]) | ~left[1:]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(new)) - 1
    out = level.take(head)
    out.end, size = level.end[tail], tail - head + 1
    run = size > 1
    out.name[run] = words.mixed(out.name[run] * _U(0xFF51AFD7ED558CCD) + size[run].astype(_U) + _U(2 * number))
    # that the symbols beside a run differ shows in the next word if that word differs from the
    # run's word at the same place, and else in the neighbour's own stretch
    n = len(tokens)
    own_left, own_right = level.start[head] - 1, level.end[tail]
    clear_left = left[head] & (tokens[np.maximum(own_left, 0)] != tokens[level.end[head] - 1])
    clear_right = right[tail] & (tokens[np.minimum(own_right, n - 1)] != tokens[level.start[tail]])
    out.da = np.minimum(level.da[head], np.where(clear_left, own_left, far_left[head]))
    out.db = np.maximum(level.db[tail], np.where(clear_right, own_right, far_right[tail]))
    return out


def name_pairs(level: Level, bounds: np.ndarray, number: int) -> Level:
    """Each left symbol and a right symbol after it become one symbol."""
    left, right, far_left, far_right = _neighbours(level, bounds)
    side = (words.mixed(level.name + _U(0x5851F42D4C957F2D * (number + 1) & ((1 << 64) - 1))) >> _U(63)).astype(bool)  # True: right
    opens = np.zeros(len(side), bool)
    opens[:-1] = ~side[:-1] & side[1:] & right[:-1]
    closes = np.append(False, opens[:-1])
    single = ~opens & ~closes
    # an unpaired left symbol has looked at its right neighbour, an unpaired right one at its left
    da = np.where(single & side, np.minimum(level.da, far_left), level.da)
    db = np.where(single & ~side, np.maximum(level.db, far_right), level.db)
    keep = np.flatnonzero(~closes)
    out = Level(level.name[keep], level.start[keep], level.end[keep], da[keep], db[keep], level.doc[keep])
    at, pair = np.flatnonzero(opens), opens[keep]
    out.name[pair] = words.mixed(level.name[at] * _U(0xFF51AFD7ED558CCD) + level.name[at + 1] * _U(0xC4CEB9FE1A85EC53) + _U(2 * number + 1))
    out.end[pair] = level.end[at + 1]
    out.db[pair] = np.maximum(level.db[at], level.db[at + 1])
    return out


def levels(tokens: np.ndarray, bounds: np.ndarray, rounds: int) -> list[Level]:
    at = np.arange(len(tokens))
    level = Level(tokens, at, at + 1, at, at, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)))
    out = [level]
    for number in range(rounds):
        level = name_pairs(name_runs(level, tokens, bounds, number), bounds, number)
        out.append(level)
    return out


def window_anchors(tokens: np.ndarray, bounds: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, keys, anchors): each window of the texts, its anchor's key, and a number for the anchor's place.

    The key is the fingerprint of the anchor's level and of all the words that decided it.
    """
    n = len(tokens)
    valid = np.zeros(n + 1, bool)
    size = np.maximum(np.diff(bounds) - window + 1, 0)
    starts = common.ragged_take(np.arange(n), bounds[:-1], size)
    valid[starts] = True
    keys, places = np.zeros(n, _U), np.zeros(n, np.int64)
    open_at = starts
    for number, level in reversed(list(enumerate(levels(tokens, bounds, rounds)))):
        if not len(open_at):
            break
        # the interior symbols of the window at p are those from low[p] to high[p]
        before = np.cumsum(np.bincount(level.da + 1, minlength=n + 2))
        until = np.cumsum(np.bincount(level.db, minlength=n + 2))
        low, high = before[open_at], until[open_at + window - 1] - 1
        has = high >= low
        p, low, high = open_at[has], low[has], high[has]
        open_at = open_at[~has]
        if not len(p):
            continue
        power = np.frexp(high - low + 1)[1] - 1
        least = [np.arange(len(level.name))]
        order = words.mixed(level.name ^ _U(0xA0761D6478BD642F))
        for k in range(int(power.max())):
            a = least[-1]
            b = np.append(a[1 << k :], a[len(a) - (1 << k) :])[: len(a)]
            least.append(np.where(order[b] < order[a], b, a))
        table = np.stack(least)
        a, b = table[power, low], table[power, high - (1 << power) + 1]
        chosen = np.where(order[b] < order[a], b, a)
        used = np.unique(chosen)
        key = np.zeros(len(level.name), _U)
        key[used] = words.range_hashes(tokens, level.da[used], level.db[used] + 1) + _U(number)
        keys[p], places[p] = key[chosen], chosen * (rounds + 1) + number
    return starts, keys[starts], places[starts]


def _texts(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = common.byte_view(strings)
    return raw, *words.byte_words(raw, offsets)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.LargeStringArray]]:
    for batch in batches:
        strings = common.plain_strings(batch.column("text"))
        for a, b in common.text_slices(strings):
            yield batch.slice(a, b - a), strings.slice(a, b - a)


def remove_repeats(docs: DataFrame, window: int = 20, rounds: int = 3, kept: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): what is left of each text of ``docs`` (doc_id, text).

    ``kept_sha256`` is of the kept words joined by blanks; ``kept`` adds them as ``kept_text``.
    """
    scanned, ids = _placed(docs)
    texts = scanned.repartition("place")  # one exchange of the texts, which all steps below share

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in _sliced(batches):
            raw, starts, lens, bounds = _texts(strings)
            long = np.flatnonzero(np.diff(bounds) >= window)
            d1, d2 = words.sequence_digests(raw, starts, lens, bounds[long], bounds[long + 1])
            yield pa.RecordBatch.from_arrays([batch.column("place").take(pa.array(long)), pa.array(d1), pa.array(d2), pa.array(np.diff(bounds)[long])], ["place", "d1", "d2", "n_words"])

    info = common.written(scanned.mapInArrow(digests, "place long, d1 long, d2 long, n_words long"), "digests")
    heads = info.groupBy("d1", "d2").agg(F.min("place").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # a table of its own, so that the rows of a large group of copies can be split between tasks
    heads = common.written(heads, "heads")
    copies = common.written(info.join(common.small(heads), ["d1", "d2"]).filter("place <> head").select("place", "n_words"), "copies")
    common.drop(info, heads)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in _sliced(batches):
            raw, starts, lens, bounds = _texts(strings)
            at, keys, anchor = window_anchors(words.word_hashes(raw, starts, lens)[0], bounds, window, rounds)
            if not len(at):
                continue
            head = np.unique(anchor, return_index=True)[1]  # each anchor once
            owner = np.searchsorted(bounds, at[head], "right") - 1
            place = np.asarray(batch.column("place"))[owner]
            order = np.lexsort((place, keys[head]))
            k, d = keys[head][order], place[order]
            own = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
            yield pa.RecordBatch.from_arrays([pa.array(k[own].view(np.int64)), pa.array(d[own]), pa.array(np.diff(np.r_[own, len(k)]) > 1)], ["key", "place", "more"])

    # an anti join would be pushed below the exchange, and the texts would be shuffled once more
    others = texts.join(copies.select("place", F.lit(True).alias("copy")), "place", "left").filter("copy IS NULL").select("place", "text")
    occurrences = others.mapInArrow(anchors, "key long, place long, more boolean")
    shared = occurrences.groupBy("key").agg(F.sum(F.when(F.col("more"), 2).otherwise(1)).alias("n")).filter("n > 1").select("key")
    wanted = occurrences.select("key", "place").join(shared, "key").groupBy("place").agg(F.collect_list("key").alias("keys"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch, strings in _sliced(batches):
            raw, starts, lens, bounds = _texts(strings)
            at, keys, _ = window_anchors(words.word_hashes(raw, starts, lens)[0], bounds, window, rounds)
            owner = np.searchsorted(bounds, at, "right") - 1
            # an anchor is looked for among the shared ones of its own text
            lists = batch.column("keys")
            bound = np.asarray(lists.offsets, np.int64)
            mine = np.asarray(lists.flatten()).view(_U)
            salt = words.mixed(np.arange(len(strings)).astype(_U) + _U(1))
            known = np.sort(mine ^ np.repeat(salt, np.diff(bound)))
            probe = keys ^ salt[owner]
            near = np.minimum(np.searchsorted(known, probe), max(len(known) - 1, 0))
            hit = known[near] == probe if len(known) else np.zeros(len(at), bool)
            at, owner = at[hit], owner[hit]
            place = np.asarray(batch.column("place"))[owner]
            held.append((*words.sequence_digests(raw, starts, lens, at, at + window), place, at - bounds[owner]))
            size += len(at)
            if size >= FLUSH:
                yield from _send(held)
                held, size = [], 0
        yield from _send(held)

    candidates = texts.join(wanted, "place").mapInArrow(windows, "w1 long, w2 long, place long, pos int, size int")
    group = Window.partitionBy("w1", "w2")
    earlier = F.min(F.struct("place", "pos")).over(group) < F.struct("place", "pos")
    # rows of size 0 are the first ones of a task, others are stretches of windows already known to be repeats
    repeats = candidates.select("place", "pos", "size", earlier.alias("late")).filter("late OR size > 0")
    repeats = repeats.groupBy("place").agg(F.collect_list("pos").alias("pos"), F.collect_list("size").alias("size"))
    whole = copies.select("place", F.array(F.lit(0)).alias("pos"), F.array((F.col("n_words") - window + 1).cast("int")).alias("size"))
    names = ["place", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * kept

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in _sliced(batches):
            raw, starts, lens, bounds = _texts(strings)
            marks = np.zeros(len(starts) + 1, np.int64)
            for i in range(batch.num_rows):
                if batch.column("pos")[i].is_valid:
                    pos = np.asarray(batch.column("pos")[i].values, np.int64) + bounds[i]
                    size = np.maximum(np.asarray(batch.column("size")[i].values, np.int64), 1)
                    np.add.at(marks, pos, 1)
                    np.add.at(marks, pos + size + window - 1, -1)
            gone = np.cumsum(marks)[:-1] > 0
            stay = ~gone
            left = common.sums(stay.astype(np.int64), bounds)
            flat = common.ragged_take(np.append(raw, np.uint8(0)), starts[stay], lens[stay] + 1)
            flat[np.cumsum(lens[stay] + 1) - 1] = 0x20
            ends = np.r_[0, np.cumsum(common.sums(np.where(stay, lens + 1, 0), bounds))].tolist()
            outs = [flat[a : max(a, b - 1)].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            n = np.diff(bounds)
            columns = [batch.column("place"), pa.array(n, pa.int64()), pa.array(n - left, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in outs])]
            if kept:
                columns.append(pa.array([x.decode() for x in outs]))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "place long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * kept
    done = texts.join(repeats.unionByName(whole), "place", "left").mapInArrow(finish, schema)
    if ids is None:
        return done.withColumnRenamed("place", "doc_id")
    return done.join(ids, "place").select("doc_id", *names[1:])


def _send(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Each distinct window's first place, and stretches of the windows that follow their equals."""
    if not held:
        return
    w1, w2, place, pos = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((pos, place, w2, w1))
    first = np.zeros(len(order), bool)
    a, b = w1[order], w2[order]
    first[:1] = True
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    # an equal place (rows can't share one) is never later than itself
    f = order[first]
    late = np.ones(len(order), bool)
    late[f] = False
    late = np.flatnonzero(late)
    late = late[np.lexsort((pos[late], place[late]))]
    head = np.flatnonzero(np.r_[True, (place[late][1:] != place[late][:-1]) | (np.diff(pos[late]) != 1)][: len(late)])
    size = np.diff(np.r_[head, len(late)])
    s = late[head]
    # stretches get keys of their own, so that they take part in no group
    own = words.mixed(words.mixed(place[s].astype(_U)) + pos[s].astype(_U)).view(np.int64)
    columns = [np.r_[w1[f], own], np.r_[w2[f], ~own], np.r_[place[f], place[s]], np.r_[pos[f], pos[s]].astype(np.int32), np.r_[np.zeros(len(f), np.int32), size.astype(np.int32)]]
    for i in range(0, len(columns[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 200_000]) for c in columns], ["w1", "w2", "place", "pos", "size"])


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Texts with a distinct, never null ``place`` in document order, and (place, doc_id) if it isn't the id itself."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    odd = texts.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").limit(1).count()
    if not odd:
        return texts.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("place"), "text"), None
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered = common.written(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("within")), "placed")
    # the id within a partition starts at part << 33
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    first = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    placed = ordered.join(first, "part").withColumn("place", F.coalesce(F.col("first") + F.expr("within & ((1L << 33) - 1)"), F.lit(0).cast("long")))
    placed = common.written(placed.select("place", "doc_id", "text"), "placed")
    return placed.select(F.coalesce("place", F.lit(0).cast("long")).alias("place"), "text"), placed.select("place", "doc_id")
