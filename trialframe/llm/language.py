"""Language identification with a byte convolutional network, trained and run in numpy.

Texts in lower case are cut into fixed windows of bytes that cover them whole. Each window goes
through a byte embedding, convolutions of several widths, a rectifier, maximum pooling over the
window, and a softmax layer; a text's probabilities are the mean over its windows, weighted by
their letters. For use, the embedding and the filters are folded into two tables over byte
pairs, so that a convolution is two table rows added up.

The network is fitted on the driver to a bounded sample: at most about ``per_language`` different labelled rows of each language
and about ``max_rows`` in all, but LEAST_ROWS of each language at least (chosen by a hash of id and text, the same at any
partitioning), and of each up to ``pieces`` stretches of WINDOW characters that lie evenly over its whole text. Every language
that a row is labelled with is learnt. Everything else covers all rows and whole texts.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null id are never
learnt from and are not held out. Without any labelled row everything is ``und``.

Of equally probable languages the first in alphabetical order is predicted. Repeated rows are predicted alike; of equal rows one is learnt from. A text is one cell, and
its windows are scored in blocks; a very long one needs a few times its size. Columns named like the results are left out of them. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 12
SPAN = max(WIDTHS)
#: rows of a language that are learnt from, if it has so many
LEAST_ROWS = 10
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def cut_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, owner): each text's bytes in rows of WINDOW, zeros at the end; empty texts have none."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), n)
    first = np.cumsum(n) - n
    rows = np.zeros((len(owner), WINDOW), np.uint8)
    inside = np.arange(len(raw)) - np.repeat(offsets[:-1], size)
    rows[np.repeat(first, size) + inside // WINDOW, inside % WINDOW] = raw
    return rows, owner


class ByteNet:
    """The network; ``fit`` learns it and ``probabilities`` applies it to windows."""

    def __init__(self, languages: list[str], seed: int = 7):
        self.languages = languages
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.mask = np.zeros((SPAN, 1, n), np.float32)  # narrow filters see fewer bytes
        for k, width in enumerate(WIDTHS):
            self.mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
        self.params = {
            "embed": rng.normal(0, 0.5, (256, EMBED)),
            "conv": rng.normal(0, 0.3, (SPAN, EMBED, n)) * self.mask,
            "bias": np.zeros(n),
            "dense": rng.normal(0, 0.3, (n, len(languages))),
            "shift": np.zeros(len(languages)),
        }
        self.params = {k: v.astype(np.float32) for k, v in self.params.items()}

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross-entropy; windows (n, WINDOW) of bytes, labels (n,)."""
        rng = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), batch):
                at = order[a : a + batch]
                step += 1
                for name, grad in self._gradients(windows[at], labels[at]).items():
                    m, v = moment[name]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    self.params[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        b, positions = len(x), x.shape[1] - SPAN + 1
        embedded = p["embed"][x]
        patches = np.lib.stride_tricks.sliding_window_view(embedded, SPAN, axis=1)[:, :positions].transpose(0, 1, 3, 2).reshape(b * positions, SPAN * EMBED)
        response = (patches @ p["conv"].reshape(SPAN * EMBED, -1)).reshape(b, positions, -1)
        best = response.argmax(axis=1)
        pooled = np.take_along_axis(response, best[:, None], 1)[:, 0] + p["bias"]
        hidden = np.maximum(pooled, 0)
        out = softmax(hidden @ p["dense"] + p["shift"])
        out[np.arange(b), y] -= 1
        out /= b
        back = (out @ p["dense"].T) * (pooled > 0)
        rows = np.arange(b)[:, None]
        chosen = patches.reshape(b, positions, -1)[rows, best]  # (b, filters, SPAN * EMBED)
        conv = np.einsum("bf,bfk->kf", back, chosen).reshape(SPAN, EMBED, -1) * self.mask
        embed = np.zeros_like(p["embed"])
        for k in range(SPAN):
            np.add.at(embed, x[rows, best + k].ravel(), (back[:, :, None] * p["conv"][k].T[None]).reshape(-1, EMBED))
        return {"embed": embed, "conv": conv, "bias": back.sum(0), "dense": hidden.T @ out, "shift": out.sum(0)}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Response of the first and the last two bytes of a patch for each pair of bytes."""
        one = np.einsum("ve,kef->kvf", self.params["embed"], self.params["conv"])
        pair = [(one[k][:, None] + one[k + 1][None]).reshape(1 << 16, -1) for k in (0, 2)]
        return pair[0], pair[1]

    def probabilities(self, windows: np.ndarray, step: int = 64) -> np.ndarray:
        if not hasattr(self, "pairs"):
            self.pairs = self.tables()
        first, last = self.pairs
        out = np.zeros((len(windows), len(self.languages)))
        for a in range(0, len(windows), step):
            x = windows[a : a + step].astype(np.int32)
            pair = (x[:, :-1] << 8) | x[:, 1:]
            response = first[pair[:, :-2]]
            response += last[pair[:, 2:]]
            hidden = np.maximum(response.max(axis=1) + self.params["bias"], 0)
            out[a : a + step] = softmax(hidden @ self.params["dense"] + self.params["shift"])
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "pairs"}


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = 400, max_rows: int = 20_000, pieces: int = 8) -> ByteNet | None:
    """A network fitted to labelled rows of ``docs`` (doc_id, text, lang) that are not held out."""
    spark = docs.sparkSession
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return None
    languages = sorted(counts)
    each = min(per_language, max(LEAST_ROWS, max_rows // len(languages)))
    shares = spark.createDataFrame([(i, lang, min(1.0, each / counts[lang])) for i, lang in enumerate(languages)], "number int, lang string, share double")
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1_000_000)) / 1_000_000
    size = F.length("text")
    n = F.greatest(F.lit(1), F.least(F.lit(pieces), F.ceil(size / WINDOW))).cast("int")
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(i * F.greatest(size - WINDOW, F.lit(0)) / F.greatest(n - 1, F.lit(1))).cast("int"))
    sample = F.transform(at, lambda x: F.substring("text", x + 1, F.lit(WINDOW)))
    # the languages' table is as small as the network; equal rows are drawn together, and count once
    picked = labelled.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("doc_id", "number", sample.alias("sample")).distinct()
    rows = sorted((r["doc_id"], r["number"], piece) for r in picked.collect() for piece in r["sample"])
    strings = pc.utf8_lower(pa.array([r[2] for r in rows], pa.large_string()))
    windows, owner = cut_windows(*common.byte_view(strings))
    labels = np.array([r[1] for r in rows], np.int64)[owner]
    # short texts too: from a part of the windows only some bytes stay
    rng = np.random.default_rng(5)
    short = rng.random(len(windows)) < 0.4
    windows = np.concatenate([windows, windows[short]])
    labels = np.concatenate([labels, labels[short]])
    stay = np.full(len(windows), WINDOW)
    stay[len(stay) - short.sum() :] = rng.integers(12, 120, short.sum())
    windows[np.arange(WINDOW)[None] >= stay[:, None]] = 0
    net = ByteNet(languages)
    if len(windows):
        net.fit(windows, labels)
    return net


def predict_slice(strings: pa.LargeStringArray, net: ByteNet) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    raw, offsets = common.byte_view(pc.utf8_lower(strings))
    windows, owner = cut_windows(raw, offsets)
    letters = (_ASCII_LETTER[windows] | (windows >= 0xC3)).sum(axis=1) + 0.01
    mass = net.probabilities(windows) * letters[:, None]
    total = np.stack([np.bincount(owner, mass[:, k], len(strings)) for k in range(len(net.languages))], axis=1)
    total /= np.maximum(np.bincount(owner, letters, len(strings)), 1e-9)[:, None]
    best = total.argmax(axis=1)
    some = common.sums(_ASCII_LETTER[raw].astype(np.int64), offsets) > 0
    out = [net.languages[k] for k in best.tolist()]
    for i in np.flatnonzero(~some):
        if not any(map(str.isalpha, strings[i].as_py())):
            out[i] = "und"
            total[i] = 0
    return out, np.minimum(total[np.arange(len(best)), best], 1.0)


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but clashing ones, with ``lang_pred`` and ``score`` (0 to 1)."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if net is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(*keep)
    schema = common.with_fields(rows, "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = common.plain_strings(batch.column(text))
            for a, b in common.text_slices(strings):
                lang, score = predict_slice(strings.slice(a, b - a), shared.value)
                columns = [batch.column(c).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    return common.spread(rows).mapInArrow(run, schema)
