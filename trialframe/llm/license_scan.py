"""License notices in texts by an exact set-similarity join, in DataFrame functions only.

A template is a notice; its set are its distinct words. A text is cut into overlapping blocks: with ``s``, a power of two and at
least the template's number of words, block b holds words b * s to b * s + 2 * s - 1, so every passage of s words lies within one block.
A block matches if it holds ``threshold`` of the template's set. The words are ordered by their frequency over all
texts, rare ones first, and three filters find the blocks:

- prefix: the rarest shared word is among the first |T| - need + 1 of the template, so only these words make candidates;
- length: a block with fewer than ``need`` words of any template can't match;
- position: what follows that word in the template's and in the block's order must still reach ``need``.

A candidate carries its block's words of the templates' vocabulary, sliced from its text's own row, so no text and no list of words is
shuffled or joined with another. Of a block's candidates for one template only that by its rarest shared word goes on to the exact count.
Templates with ``consecutive`` words then keep the places where these stand one after another.

Bounds: everything made of the templates (vocabulary, ranks, prefixes) is part of the plan or broadcast; it grows with the caller's list,
not with the texts, and is refused beyond MAX_WORDS.

Null text counts as empty and has no words. Each row of ``docs`` is scanned by itself, so repeated or null ids stay rows of their own, and
other columns don't matter. Words equally frequent are ordered by themselves, so ties don't change results. A text without matches has no
rows in ``matches`` and empty labels in ``digest``; an empty table gives none. A text is one row, however long it is; its candidates are of bounded size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: words of all templates together
MAX_WORDS = 200_000
LEAST_STRIDE = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what stands between words: all of ASCII but letters and digits
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ASCII_LOWER = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Template:
    """``consecutive``: the words must stand one after another. ``base``: counts in the digest's base columns."""

    label: str
    text: str
    threshold: float = 0.8
    consecutive: bool = False
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATOR, self.text.translate(_ASCII_LOWER)) if w]

    @property
    def stride(self) -> int:
        return max(LEAST_STRIDE, 1 << (len(self.words) - 1).bit_length())

    @property
    def need(self) -> int:
        """Words of the set that a matching block holds."""
        return max(1, ceil(self.threshold * len(set(self.words)) - 1e-9))


#: short statements of a licence (all of their words), phrases (consecutive), and standard notices
TEMPLATES = (
    Template("cc-by", "cc by", 1.0, True, True),
    Template("gpl", "general public license", 1.0, True, True),
    Template("reserved", "all rights reserved", 1.0, True, True),
    Template("mit", "mit license", 1.0, True),
    Template("apache-2.0", "apache license version 2 0", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
    Template("cc-by-sa", "cc by sa", 1.0, True),
    Template("cc0", "cc0 1 0 universal", 1.0, True),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential"),
)


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<int>")


def template_hits(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(row, doc_id, n_words, at, word): of each text, where words of the vocabulary stand (from 0) and their numbers in it."""
    size = 1 << max(len(vocabulary) // 2, 1).bit_length()
    numbered = docs.sparkSession.createDataFrame(list(enumerate(vocabulary)), "id int, word string")
    buckets: list[list[tuple[str, int]]] = [[] for _ in range(size)]
    for r in numbered.select("word", "id", F.pmod(F.hash("word"), F.lit(size)).alias("bucket")).collect():
        buckets[r.bucket].append((r.word, r.id))
    # a table of small maps, since Spark looks through a map from its start
    table = F.array(*[F.create_map(*[F.lit(x) for pair in b for x in pair]) if b else F.create_map().cast("map<string,int>") for b in buckets])

    def number(word: Column) -> Column:
        return F.try_element_at(F.get(table, F.pmod(F.hash(word), F.lit(size))), word)

    def looked_up(word: Column) -> Column:
        other = F.lit(None).cast("int") if all(w.isascii() for w in vocabulary) else number(F.translate(word, UPPER, LOWER))
        return F.when(F.octet_length(word) == F.length(word), number(F.lower(word))).otherwise(other)

    words = F.array_remove(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), SEPARATOR), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    rows = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.transform("words", looked_up).alias("ids"))
    hits = F.filter(F.transform("ids", lambda w, i: F.when(w.isNotNull(), F.struct(i.alias("at"), w.alias("word")))), lambda h: h.isNotNull())
    return rows.select("row", "doc_id", "n_words", hits.alias("h")).select("row", "doc_id", "n_words", F.col("h.at").alias("at"), F.col("h.word").alias("word"))


def ranks(hits: DataFrame, vocabulary: list[str]) -> list[int]:
    """For each word of the vocabulary its place by frequency over all texts, the rarest first."""
    seen = {r.word: r.n for r in hits.select(F.explode("word").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(range(len(vocabulary)), key=lambda i: (seen.get(i, 0), vocabulary[i]))
    out = [0] * len(order)
    for place, i in enumerate(order):
        out[i] = place
    return out


def candidates(hits: DataFrame, rank: list[int], sets: list[list[int]], templates: list[Template]) -> DataFrame:
    """(row, template, block, at, rank, words): blocks by one of their words in a template's prefix, with all their words (at, rank)."""
    owners: list[list[int]] = [[] for _ in rank]
    for t, (own, template) in enumerate(zip(sets, templates, strict=True)):
        for r in own[: len(own) - template.need + 1]:
            owners[r].append(t)
    prefix = F.array(*[_numbers(x) for x in owners]).cast("array<array<int>>")
    strides = _numbers([t.stride for t in templates])
    ranked = F.transform("word", lambda w: F.get(_numbers(rank), w))
    rows = hits.filter(F.size("word") > 0).select("row", F.arrays_zip(F.col("at"), ranked.alias("rank")).alias("h"))
    rare = F.filter(F.transform("h", lambda h, k: F.when(F.size(F.get(prefix, h["rank"])) > 0, F.struct(k.alias("k"), h["at"].alias("at"), h["rank"].alias("rank")))), lambda x: x.isNotNull())
    rows = rows.select("row", "h", rare.alias("rare")).filter(F.size("rare") > 0)

    def blocks(hit: Column) -> Column:
        def of(template: Column, back: int) -> Column:
            s = F.get(strides, template)
            b = F.floor(hit["at"] / s).cast("int") - back
            first = F.greatest(hit["k"] + 1 - 2 * s, F.lit(1))
            near = F.filter(F.slice("h", first, 4 * s), lambda x: (x["at"] >= b * s) & (x["at"] < (b + 2) * s))
            return F.when(b >= 0, F.struct(template.alias("template"), b.alias("block"), hit["at"].alias("at"), hit["rank"].alias("rank"), near.alias("words")))

        return F.flatten(F.transform(F.get(prefix, hit["rank"]), lambda t: F.array(of(t, 0), of(t, 1))))

    found = rows.select("row", F.explode(F.flatten(F.transform("rare", blocks))).alias("c"))
    return found.filter(F.col("c").isNotNull()).select("row", "c.*")


def matches(hits: DataFrame, vocabulary: list[str], templates: list[Template]) -> DataFrame:
    """(row, template, label, base, start, end, places, containment): the blocks that match. [start, end) are the words from the
    first to the last shared one; ``places`` are the starts of consecutive words in a block (only where the template asks for these)."""
    rank = ranks(hits, vocabulary)
    known = {w: rank[i] for i, w in enumerate(vocabulary)}
    sets = [sorted({known[w] for w in t.words}) for t in templates]
    rows = [(i, t.label, t.base, t.consecutive, t.stride, t.need, own, [known[w] for w in t.words]) for i, (t, own) in enumerate(zip(templates, sets, strict=True))]
    table = hits.sparkSession.createDataFrame(rows, "template int, label string, base boolean, consecutive boolean, stride int, need int, own array<int>, sequence array<int>")
    met = candidates(hits, rank, sets, templates).join(F.broadcast(table), "template")
    met = met.withColumn("set", F.array_sort(F.array_distinct("words.rank"))).filter(F.size("set") >= F.col("need"))
    left = F.least(F.size("own") - F.array_position("own", F.col("rank")), F.size("set") - F.array_position("set", F.col("rank"))) + 1
    met = met.filter(left >= F.col("need")).withColumn("shared", F.array_intersect("own", "set"))
    # by the rarest shared word, and where it stands first
    earlier = F.exists("words", lambda w: (w["rank"] == F.col("rank")) & (w["at"] < F.col("at")))
    met = met.filter((F.size("shared") >= F.col("need")) & (F.get("shared", F.lit(0)) == F.col("rank")) & ~earlier)

    def stands(start: Column) -> Column:
        own = (start["at"] >= F.col("block") * F.col("stride")) & (start["at"] < (F.col("block") + 1) * F.col("stride"))
        rest = F.transform("sequence", lambda w, i: F.struct((start["at"] + i).alias("at"), w.alias("rank")))
        return own & (F.size(F.array_except(rest, F.col("words"))) == 0)

    places = F.when(F.col("consecutive"), F.transform(F.filter("words", stands), lambda w: w["at"]))
    met = met.withColumn("places", places).filter("NOT consecutive OR size(places) > 0")
    inside = F.transform(F.filter("words", lambda w: F.array_contains("shared", w["rank"])), lambda w: w["at"])
    start = F.when(F.col("consecutive"), F.array_min("places")).otherwise(F.array_min(inside))
    end = F.when(F.col("consecutive"), F.array_max("places") + F.size("sequence")).otherwise(F.array_max(inside) + 1)
    return met.select("row", "template", "label", "base", start.alias("start"), end.alias("end"), "places", (F.size("shared") / F.size("own")).alias("containment"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """(texts, matches): texts are the rows of ``docs`` (doc_id, text) as (row, doc_id, n_words), and ``row`` joins them with their matches."""
    listed = [t for t in templates if t.words]
    vocabulary = sorted({w for t in listed for w in t.words})
    if sum(len(t.words) for t in listed) > MAX_WORDS:
        raise ValueError(f"templates of over {MAX_WORDS} words together")
    hits = common.written(template_hits(docs, vocabulary), "licenses")
    return hits.select("row", "doc_id", "n_words"), matches(hits, vocabulary, listed)


def digest(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score): one row for each text; n_base counts the places of
    base templates, score is the greatest containment of a matching block (0: none)."""
    texts, found = scan(docs, templates)
    base = F.col("base") & F.col("places").isNotNull()
    found = found.groupBy("row").agg(
        F.sum(F.when(base, F.size("places"))).alias("n_base"),
        F.min(F.when(base, F.array_min("places"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.array_max("places"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("containment").alias("score"),
    )
    filled = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    joined = texts.join(found, "row", "left").withColumns({n: F.coalesce(n, v) for n, v in filled.items()})
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
