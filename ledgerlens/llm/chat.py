"""Chat formatting with typed content parts.

A message is a list of typed parts (text, image, audio, document). ``Flattener``
visits them in order and writes one string: text is escaped, every other part
becomes a placeholder, its reference goes to the attachment list and its expanded
length to the token count. ``format_turns`` applies it to a table of turns.

Template of a turn::

    <|turn|>ROLE<|text|>TEXT<|end|>

Control strings all start with ``<|``. Inside roles and texts every ``<`` that is
followed by ``|`` or by a backslash run that ends in ``|`` gets one more backslash
(``<|`` is written ``<\\|``, ``<\\|`` is written ``<\\\\|``), so no content can
produce a control string and taking one backslash away restores it exactly.

The formatted conversation is the concatenation of its turns' pieces in order.
A piece depends on its own row alone, so formatting is a narrow step: a
conversation of any length is never held in one task. Reading back streams over
sorted rows and keeps only running hashes.

Edge cases: null text is an empty text part; null role is the empty role; null
turns sort first; turns with equal numbers are ordered by role, then text; a null
conversation id is a conversation; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import record, shuffle_width, small_batches

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
PIECE = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)
_RISKY = re.compile(r"<(\\*\|)")
_MARKED = re.compile(r"<\\(\\*\|)")
# Tokens that one attachment of each kind expands to, before its own size.
IMAGE_PATCH, IMAGE_BASE, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE = 14, 2, 25, 512


def escape(text: str) -> str:
    return _RISKY.sub(r"<\\\1", text) if "<" in text else text


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1", text) if "<\\" in text else text


@dataclass
class TextPart:
    text: str

    def accept(self, visitor: "Flattener") -> None:
        visitor.text(self)


@dataclass
class ImagePart:
    ref: str
    width: int
    height: int

    def accept(self, visitor: "Flattener") -> None:
        cells = -(-self.width // IMAGE_PATCH) * -(-self.height // IMAGE_PATCH)
        visitor.attachment("image", self.ref, IMAGE_BASE + cells)


@dataclass
class AudioPart:
    ref: str
    seconds: float

    def accept(self, visitor: "Flattener") -> None:
        visitor.attachment("audio", self.ref, -int(-self.seconds * AUDIO_PER_SECOND // 1))


@dataclass
class DocumentPart:
    ref: str
    pages: int

    def accept(self, visitor: "Flattener") -> None:
        visitor.attachment("document", self.ref, self.pages * DOCUMENT_PER_PAGE)


@dataclass
class Flattener:
    """Visitor over a message's parts: ordered output, attachment references, token counts, text spans."""

    out: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    refs: list[tuple[str, str]] = field(default_factory=list)
    tokens: int = 0
    at: int = 0

    def write(self, piece: str) -> None:
        self.out.append(piece)
        self.at += len(piece)

    def text(self, part: TextPart) -> None:
        start = self.at
        self.write(escape(part.text))
        self.spans.append((start, self.at))

    def attachment(self, kind: str, ref: str, tokens: int) -> None:
        self.write(f"<|{kind}:{len(self.refs)}|>")
        self.refs.append((kind, ref))
        self.tokens += tokens


def flatten(role: str, parts: list, learn: bool) -> tuple[str, list[tuple[int, int]], list[tuple[str, str]], int]:
    """Formatted piece, loss spans in it (of text parts, if ``learn``), attachments and their tokens."""
    visitor = Flattener()
    visitor.write(TURN + escape(role) + BODY)
    for part in parts:
        part.accept(visitor)
    visitor.write(END)
    return "".join(visitor.out), visitor.spans if learn else [], visitor.refs, visitor.tokens


PART_TYPE = ("array<struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>>")


def _part(p: dict):
    kind = p["type"]
    if kind == "text":
        return TextPart(p["text"] or "")
    if kind == "image":
        return ImagePart(p["ref"] or "", p["width"] or 0, p["height"] or 0)
    if kind == "audio":
        return AudioPart(p["ref"] or "", p["seconds"] or 0.0)
    if kind == "document":
        return DocumentPart(p["ref"] or "", p["pages"] or 0)
    raise ValueError(f"unknown part type {kind!r}")


PIECES = ("conv long, turn long, piece string, loss_start array<int>, loss_end array<int>, "
          "attachments array<string>, attachment_tokens long")


def _format(batches: Iterator[pa.RecordBatch], learn_roles: frozenset) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = batch.to_pydict()
        done = []
        for role, parts in zip(cols["role"], cols["parts"]):
            role = role or ""
            done.append(flatten(role, [_part(p) for p in parts or []], role in learn_roles))
        yield record({
            "conv": batch["conv"], "turn": batch["turn"],
            "piece": pa.array([d[0] for d in done], pa.string()),
            "loss_start": pa.array([[s for s, _ in d[1]] for d in done], pa.list_(pa.int32())),
            "loss_end": pa.array([[e for _, e in d[1]] for d in done], pa.list_(pa.int32())),
            "attachments": pa.array([[f"{k}:{r}" for k, r in d[2]] for d in done], pa.list_(pa.string())),
            "attachment_tokens": pa.array([d[3] for d in done], pa.int64())})


def text_parts(text) -> "F.Column":
    """A plain text column as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                            F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
                            F.lit(None).cast("int").alias("pages"))).cast(PART_TYPE)


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 parts: str | None = None, learn_roles=("assistant",)) -> DataFrame:
    """One formatted piece per turn: ``PIECES``.

    ``parts`` names a column of type ``PART_TYPE``; without it ``text`` is the one
    part. Loss spans are code point ranges of the piece.
    """
    small_batches(turns)
    given = F.col(parts) if parts else text_parts(F.col(text))
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), given.alias("parts"))
    learn = frozenset(learn_roles)
    return rows.mapInArrow(lambda batches: _format(batches, learn), PIECES)


def _order(piece) -> list:
    """What orders turns of one number: role, then text, as they were before escaping. Read from the piece where it is
    sorted, so neither travels twice."""
    parts = [F.regexp_extract(piece, PIECE.pattern.replace(".*?", "[\\s\\S]*?"), k) for k in (1, 2)]
    return [F.regexp_replace(p, _MARKED.pattern, "<$1").alias(n) for p, n in zip(parts, ("by_role", "by_text"))]


def conversation_text(pieces: DataFrame) -> DataFrame:
    """``conv, formatted``: a conversation's pieces in order as one string, for conversations that fit one row."""
    rows = F.array_sort(F.collect_list(F.struct("turn", *_order(F.col("piece")), "piece")))
    return pieces.groupBy("conv").agg(F.array_join(F.transform(rows, lambda x: x["piece"]), "").alias("formatted"))


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


class _Running:
    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, starts: list[int], ends: list[int]) -> None:
        found = PIECE.fullmatch(piece)
        if not found:
            raise ValueError("a piece that is not one turn")
        role, text = unescape(found[1]), unescape(found[2])
        self.turns += 1
        self.chars += len(piece)
        self.all.update(f"{role}\n{text}\n".encode())
        for s, e in zip(starts, ends):
            learnt = unescape(piece[s:e])
            self.loss += len(learnt)
            self.learnt.update(learnt.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    now = None
    for batch in batches:
        rows = []
        cols = batch.to_pydict()
        for conv, piece, starts, ends in zip(cols["conv"], cols["piece"], cols["loss_start"], cols["loss_end"]):
            if now is None or now.conv != conv:
                if now is not None:
                    rows.append(now.row())
                now = _Running(conv)
            now.add(piece, starts, ends)
        if rows:
            yield out(rows)
    if now is not None:
        yield out([now.row()])


def read_back(pieces: DataFrame) -> DataFrame:
    """``READ`` per conversation, parsed from the formatted pieces.

    Turns meet by conversation and stream through in order; a task keeps two
    running hashes, never a conversation.
    """
    width = shuffle_width(pieces.sparkSession)
    return (pieces.select("conv", "turn", "piece", "loss_start", "loss_end")
            .repartition(width, "conv").select("*", *_order(F.col("piece"))).sortWithinPartitions("conv", "turn", "by_role", "by_text")
            .select("conv", "piece", "loss_start", "loss_end").mapInArrow(_read, READ))
