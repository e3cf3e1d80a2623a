"""Chat formatting with typed content parts.

A turn's content is a list of typed parts. A visitor flattens them: text is escaped, and an image,
audio or document part becomes a placeholder at its place, with its reference and the number of
tokens that it will stand for recorded in order. Each turn becomes one segment of its
conversation's output, ``<|im_start|>role\\ncontent<|im_end|>\\n``; the conversation is its segments
in order of turn. Segments stay rows, so a conversation of any length is never one cell.

Escaping is reversible: a backslash in a text is doubled, and a control string gets a backslash after
its first character, so no control string of the template is left in any text. In a role a line feed becomes ``\\n`` too, since it
ends the role.

Null text, role or content counts as empty. Turns are ordered by turn (null first), then by the bytes of role and
text, so that repeated rows and ties have one order. A null conversation id is a conversation. Parts that are no JSON list of objects
count as one text part with that JSON text; a part of unknown type as a text part with its JSON; numbers that are missing,
negative or no numbers as 0. So no row is lost and none ends the job.
Digests run over a conversation's segments as a stream, in constant memory; one conversation is
one stream, because a SHA-256 of its turns can't be put together from parts.

A size of 1e9 or more counts as 0 too (``amount``), so that no sum leaves 64 bits. A turn is one cell, however long. Other columns don't matter. An empty table gives no segments.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The strings that steer models and that no text may hold unescaped.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
KINDS = ("text", *PLACEHOLDER)
CONTROL = (START, END, *PLACEHOLDER.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: the same for Spark: an escaped character, and an escaped line feed of a role
ESCAPED, ROLE_FEED = r"(?s)\\(.)", r"(?<!\\)((?:\\\\)*)\\n"

#: side of an image patch, audio tokens a second, tokens of a document page
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 256


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def read_parts(listed: str) -> list[dict]:
    """The parts of a JSON list, those of unknown type as text parts with their JSON; other text is one text part."""
    try:
        parts = json.loads(listed)
    except ValueError:
        parts = None
    if not isinstance(parts, list) or not all(isinstance(p, dict) for p in parts):
        return [{"type": "text", "text": listed}]
    return [p if p.get("type") in KINDS else {"type": "text", "text": json.dumps(p, ensure_ascii=False)} for p in parts]


def amount(part: dict, name: str) -> float:
    """A part's number, 0 where it is missing or none."""
    value = part.get(name)
    return value if isinstance(value, int | float) and not isinstance(value, bool) and 0 < value < 1e9 else 0


class Flattener:
    """Visits the parts of one turn in order; ``text`` and ``attachments`` are the outcome."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[dict] = []
        self.length = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type")
        if kind not in KINDS:
            raise ValueError(f"unknown part type {kind!r}")
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text")
        self.add(escape(text if isinstance(text, str) else "" if text is None else json.dumps(text, ensure_ascii=False)))

    def visit_image(self, part: dict) -> None:
        self.attach(part, ceil(amount(part, "width") / PATCH) * ceil(amount(part, "height") / PATCH))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, ceil(amount(part, "seconds") * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self.attach(part, ceil(amount(part, "pages")) * PAGE_TOKENS)

    def attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"position": self.length, "type": part["type"], "ref": str(part.get("ref") or ""), "tokens": tokens})
        self.add(PLACEHOLDER[part["type"]])

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    @property
    def text(self) -> str:
        return "".join(self.pieces)


ATTACHMENTS = "array<struct<position:int,type:string,ref:string,tokens:long>>"
SEGMENTS = f"conv_id long, turn long, segment string, loss_start int, loss_end int, attachments {ATTACHMENTS}"


def format_turns(turns: DataFrame, parts: str | None = None, loss_role: str = "assistant") -> DataFrame:
    """Segments of all turns (conv_id, turn, role, text): one row each, in the schema ``SEGMENTS``.

    ``parts`` names a column with the typed parts as a JSON list; without it, or where it is null,
    the text is the only part. [loss_start, loss_end) is the segment's stretch under the loss mask
    (empty for other roles).
    """
    content = F.col(parts) if parts else F.lit(None).cast("string")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), content.alias("parts"))
    attachment = pa.list_(pa.struct([("position", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for role, text, listed in zip(*(batch.column(c).to_pylist() for c in ("role", "text", "parts")), strict=True):
                flat = Flattener()
                for part in read_parts(listed) if listed is not None else [{"type": "text", "text": text}]:
                    flat.visit(part)
                head = f"{START}{escape_role(role)}\n"
                body = flat.text
                span = (len(head), len(head) + len(body)) if role == loss_role else (0, 0)
                for column, value in zip(out, (f"{head}{body}{END}\n", *span, flat.attachments), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int32(), attachment)
            columns = [batch.column(c) for c in ("conv_id", "turn")] + [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments"])

    return common.spread(rows).mapInArrow(run, SEGMENTS)


def read_segment(segment: str) -> tuple[str, str]:
    """(role, content) of a segment, unescaped; placeholders stay as they are."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, body = segment[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), unescape(body)


def digest(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, attachment_tokens) read
    back from formatted segments."""
    size = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    rows = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end", F.size("attachments").cast("long").alias("n"), size.alias("tokens"))
    # ties: role, then text, both as they were before escaping
    inside = F.substring("segment", F.lit(len(START) + 1), F.length("segment") - len(START) - len(END) - 1)
    role = F.substring_index(inside, "\n", 1)
    text = F.substring(inside, F.length(role) + 2, F.length(inside))
    plain = [F.regexp_replace(F.regexp_replace(role, ROLE_FEED, "$1\n"), ESCAPED, "$1"), F.regexp_replace(text, ESCAPED, "$1")]
    ordered = rows.withColumns({"__role": plain[0], "__text": plain[1]}).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "__role", "__text").drop("__role", "__text")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attachment_tokens"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[list] = []

        def close() -> None:
            n, turns, chars, loss, total, attached, tokens = state
            done.append([key, n, turns.hexdigest(), chars, loss.hexdigest(), total, attached, tokens])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end", "n", "tokens"))
            for conv, segment, a, b, n, tokens in zip(*columns, strict=True):
                if state is None or conv != key:
                    if state is not None:
                        close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, text = read_segment(segment)
                masked = unescape(segment[a:b])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(segment)
                state[5] += n
                state[6] += tokens
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done.clear()
        if state is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attachment_tokens long")
