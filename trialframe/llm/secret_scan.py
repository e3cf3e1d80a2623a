"""Secret scans: fixed formats and a battery of randomness tests.

*Formats.* Three kinds of match are found in whole texts: assignments to a secret-like name, cloud
access keys, and long hexadecimal runs. Matches of a kind are leftmost and don't overlap; those
that are too short are dropped after matching.

*Battery.* Every other run of at least ``min_run`` (MIN_RUN) key characters is tested. Its encoding (hex,
base32, base64 or alphanumeric) comes from its characters. A run that no alphabet holds, such as NAME=KEY
or path/KEY, is split: at ``=`` inside it, and a part that still has no alphabet at ``/`` and ``+`` and also, as a
second reading, at ``-`` and ``_``. Each piece of at least ``min_run`` is tested; pieces of both readings may overlap. Shorter runs
aren't tested: random characters of their length can't be told from ordinary ones at this rate. Three tests ask whether a run looks like
uniform draws from its alphabet: chi-squared on the characters, the number of runs above and
below the alphabet's middle, and the correlation of neighbours. A run must pass all three at level ``ALPHA`` divided by three.

*False discoveries.* Against uniform draws stands the corpus: letter-pair counts over all documents give the likelihood of the run as
ordinary text. The evidence is the ratio of both likelihoods, times a weight from the battery: the geometric mean over the three tests of
(1 + POWER) p ** POWER. Under uniform draws each of these has mean 1 or less, whatever the dependence of the tests, and so
under ordinary text the evidence has mean 1 or less: its inverse is a p-value. It falls with the run's length, and rises as the battery finds
the run less like uniform draws. The Benjamini-Hochberg rule at rate ``rate`` (RATE) is applied to it within each length class (powers of
two), over all runs tested in all documents, those that fail the battery included; for inverses of such evidence it holds under any dependence.
So many short words don't hide long keys, and the share of false finds is bounded in each class.

Null text counts as empty. Rows with equal ids are scanned as they are, one row each.

Columns of any name pass ``redact`` unchanged. A text is one cell and one slice, however long. An empty table, and a table without runs to test, has no random spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The formats and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more, as [0-9a-f]+ with shorter ones dropped
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: every assignment holds one of these
HINTS = (b"passw", b"secret", b"token", b"api")

MIN_RUN, ALPHA, RATE, POWER = 20, 0.01, 0.001, 2
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alphanumeric": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: the number of each byte in its alphabet
_NUMBER = {name: np.array([max(letters.find(chr(b)), 0) for b in range(256)]) for name, letters in ALPHABETS.items()}
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: symbols of the text model: each key character, and one for all else
_SYMBOL = np.zeros(256, np.uint16)
_SYMBOL[[ord(c) for c in ALPHABETS["alphanumeric"] + "+/_=-"]] = np.arange(1, 68)
N_SYMBOLS = 68


def encoding(run: str) -> str | None:
    """The first alphabet that holds all characters of a run (padding aside)."""
    used = set(run.rstrip("="))
    return next((name for name, letters in ALPHABETS.items() if used and used <= set(letters)), None)


#: parts between ``=``, the last with its padding; then two readings of a part
_PART = re.compile(r"[^=]+(?:=+\Z)?")
_READINGS = (re.compile(r"[^+/]+"), re.compile(r"[^_-]+"))


def run_pieces(run: str, min_run: int = MIN_RUN) -> Iterator[tuple[int, int, str]]:
    """(start, end, alphabet) of what is tested of a run: all of it if one alphabet holds it, or else its pieces of ``min_run`` or more."""
    if (name := encoding(run)) is not None:
        yield 0, len(run), name
        return
    for part in _PART.finditer(run):
        a, b = part.span()
        if b - a < min_run:
            continue
        if (name := encoding(part[0])) is not None:
            yield a, b, name
            continue
        for reading in _READINGS:
            for m in reading.finditer(run, a, b):
                if m.end() - m.start() >= min_run and (name := encoding(m[0])) is not None:
                    yield *m.span(), name


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(run: str, name: str) -> tuple[float, float, float]:
    """p-values of uniform draws: character counts, runs about the middle, neighbours' correlation."""
    k = len(ALPHABETS[name])
    number = _NUMBER[name][np.frombuffer(run.rstrip("=").encode(), np.uint8)]
    x, n = number.astype(float), len(number)
    if n < 3:
        return 0.0, 0.0, 0.0
    counts = np.bincount(number, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    # exact mean and variance under uniform draws, cube-root normal approximation of the upper tail
    mean, variance = k - 1, 2 * (k - 1) * (n - 1) / n
    degrees = 2 * mean * mean / variance
    z = ((chi / mean) ** (1 / 3) - (1 - 2 / (9 * degrees))) / math.sqrt(2 / (9 * degrees))
    p_chi = 0.5 * math.erfc(z / math.sqrt(2))
    high = x >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        expected = 1 + 2 * a * b / n
        spread = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        p_runs = two_sided((1 + int((high[1:] != high[:-1]).sum()) - expected) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    d = x - x.mean()
    total = float((d * d).sum())
    p_serial = two_sided(((d[1:] * d[:-1]).sum() / total + 1 / n) * math.sqrt(n)) if total else 0.0
    return p_chi, p_runs, p_serial


def log_weight(tests: tuple[float, float, float]) -> float:
    """Logarithm of the battery's weight in the evidence."""
    return sum(math.log1p(POWER) + POWER * math.log(max(p, 1e-300)) for p in tests) / len(tests)


class TextModel:
    """Probability of a character after another one, from counts over all documents."""

    def __init__(self, counts: np.ndarray):
        smooth = counts + 0.5
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True))

    def log_ratio(self, run: str, name: str) -> float:
        """Logarithm of the likelihood of uniform draws over that of ordinary text."""
        core = run.rstrip("=").encode()
        s = _SYMBOL[np.frombuffer(core, np.uint8)]
        return -float(self.log[np.r_[0, s[:-1]], s].sum()) - len(core) * math.log(len(ALPHABETS[name]))

    def p_value(self, run: str, name: str) -> float:
        """p-value of a run under ordinary text; 1 where the likelihood or the battery is against uniform draws."""
        ratio = self.log_ratio(run, name)
        if ratio <= 0:  # no weight of the battery can make up for it beyond log(1 + POWER)
            return 1.0
        tests = battery(run, name)
        if min(tests) < ALPHA / 3:
            return 1.0
        return math.exp(min(0.0, -ratio - log_weight(tests)))


def pair_counts(docs: DataFrame) -> np.ndarray:
    """Counts of neighbouring symbols over all whole texts; at most N_SYMBOLS**2 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_SYMBOLS * N_SYMBOLS, np.int64)
        for batch in batches:
            strings = common.plain_strings(batch.column("text"))
            for a, b in common.text_slices(strings):
                raw, offsets = common.byte_view(strings.slice(a, b - a))
                symbols = _SYMBOL[np.insert(raw, offsets[:-1], 0)]
                pairs = symbols[:-1] * np.uint16(N_SYMBOLS) + symbols[1:]
                for x in range(0, len(pairs), 1 << 18):  # bincount makes 64-bit numbers of them
                    total += np.bincount(pairs[x : x + (1 << 18)], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["pair", "n"])

    rows = common.spread(docs.select("text")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(N_SYMBOLS * N_SYMBOLS)
    for r in rows:
        counts[r["pair"]] = r["n"]
    return counts.reshape(N_SYMBOLS, N_SYMBOLS)


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, in order of start and then kind."""
    found = []
    low = raw.translate(_LOWER)
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def tested_runs(text: str, base: list[tuple[int, int, int]], model: TextModel, min_run: int = MIN_RUN) -> Iterator[tuple[int, int, float]]:
    """(start, end, p) of all runs outside the fixed formats."""
    for m in re.finditer(rf"[A-Za-z0-9+/_=-]{{{min_run},}}", text):
        for x, y, name in run_pieces(m[0], min_run):
            a, b = m.start() + x, m.start() + y
            if not any(s < b and a < e for s, _, e in base):
                yield a, b, model.p_value(text[a:b], name)


def candidates(text: str, base: list[tuple[int, int, int]], model: TextModel) -> Iterator[tuple[int, int, float]]:
    """The tested runs that aren't ruled out."""
    return (run for run in tested_runs(text, base, model) if run[2] < 1)


def length_class(n):
    return F.floor(F.log2(n)).cast("int")


def cutoffs(found: DataFrame, rate: float = RATE) -> dict[int, float]:
    """Benjamini-Hochberg p-value limit of each length class, over all runs (start, end, p) tested in the corpus.

    p-values are rounded up to a fixed grid of 1/8 powers of two, so that counts on the grid (a
    bounded table) stand for the order of all runs.
    """
    step = F.when(F.col("p") <= 0, F.lit(-1600)).otherwise(F.greatest(F.ceil(F.log2("p") * 8), F.lit(-1600))).cast("int")
    rows = found.select(length_class(F.col("end") - F.col("start")).alias("length"), step.alias("step")).groupBy("length", "step").count()
    by: dict[int, list[tuple[int, int]]] = {}
    for r in rows.collect():
        by.setdefault(r["length"], []).append((r["step"], r["count"]))
    limits = {}
    for length, steps in by.items():
        total, rank, limit = sum(c for _, c in steps), 0, 0.0
        for step_, c in sorted(steps):
            rank += c
            if 2 ** (step_ / 8) <= rate * rank / total:
                limit = 2 ** (step_ / 8)
        limits[length] = limit
    return limits


SPAN_TYPE = "array<struct<start:int,kind:int,end:int>>"


def scan(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN, rate: float = RATE) -> DataFrame:
    """All columns of ``docs`` but clashing ones, with ``base`` and ``spans``: arrays of (start, kind number, end)
    in code points, ``base`` the fixed formats, ``spans`` with the runs that the battery adds.

    ``min_run``: shortest run that is tested; ``rate``: bound on the share of false finds in each length class.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("base", "spans", "found")]
    rows = common.spread(docs.select(*keep))
    model = spark.sparkContext.broadcast(TextModel(pair_counts(rows.select(F.col(text).alias("text")))))
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    more = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column(text))
            for a, b in common.text_slices(strings):
                base, found = [], []
                for value in strings.slice(a, b - a):
                    raw = value.as_buffer().to_pybytes()
                    own = base_spans(t := raw.decode(), raw)
                    base.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
                    found.append([{"start": s, "end": e, "p": p} for s, e, p in tested_runs(t, own, model.value, min_run)])
                columns = [batch.column(c).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(base, span), pa.array(found, more)], [*keep, "base", "found"])

    schema = common.with_fields(docs.select(*keep), f"base {SPAN_TYPE}, found array<struct<start:int,end:int,p:double>>")
    scanned = common.written(rows.mapInArrow(run, schema), "secrets")
    limits = cutoffs(scanned.select(F.explode("found").alias("f")).select("f.*"), rate)
    added = F.array().cast(SPAN_TYPE)
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        passed = F.filter("found", lambda f: F.coalesce(f["p"] <= limit[length_class(f["end"] - f["start"])], F.lit(False)))
        added = F.transform(passed, lambda f: F.struct(f["start"].alias("start"), F.lit(3).alias("kind"), f["end"].alias("end")))
    return scanned.select(*keep, "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined(spans: str):
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(one, ",")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = scan(docs.select("doc_id", "text").withColumnRenamed("text", "body"), "body")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; overlapping spans become one."""
    names, schema = docs.columns, docs.schema
    other = {n: f"__{n}" for n in ("base", "spans", "found") if n in names}
    found = scan(docs.withColumnsRenamed(other)).drop("base").withColumnRenamed("spans", "__found").withColumnsRenamed({v: k for k, v in other.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, spans in zip(batch.column("text"), batch.column("__found"), strict=True):
                text, at, parts = value.as_py(), 0, []
                for s in spans.as_py() or []:
                    if s["start"] >= at:
                        parts += [text[at : s["start"]], mark]
                    at = max(at, s["end"])
                texts.append("".join([*parts, text[at:]]) if parts else text)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.select(*names, "__found").mapInArrow(run, schema)
