"""Chat formatting: turns of typed content parts as one text with placeholders and a loss mask.

A turn is a role and a list of parts: text, image, audio or document. A visitor goes through the parts
of a conversation in order. Text is escaped and written down; every other part becomes a numbered
placeholder (``<image 1>``), and its reference, its place in the text and the number of tokens it will
be expanded to are recorded. Text parts that follow each other are one text.

The template writes ``<turn:ROLE>``, a line break, the content, ``</turn>`` and a line break. Strings
that control the format all begin with ``<``. Where one appears in a text, a backslash is put before
it, and before every backslash, so that what is written can be read back exactly: an unescaped control
string is always the template's. The loss mask covers the texts of the assistant as written (escapes
included), without headers, ends and placeholders.

How it runs: rows are shuffled by conversation, sorted inside the tasks and streamed, one row out for
each turn with its segment of the text and the segment's start; ``joined`` puts the segments of a
conversation into one cell. A task holds one batch of rows and the visitor's counters, so a
conversation with very many turns needs no more memory than a short one (its turns do share one task,
as placeholders are numbered and offsets counted through it); only ``joined`` builds whole texts.

Defined results: turns are ordered by turn (nulls first), then role and text; repeated rows are turns
like any others. Rows without conv_id are one conversation, with a null id. A null text or an empty
list of parts is an empty text, a null role an empty role. A part with a type of no rule raises. An
empty table gives an empty result. Further columns are ignored. Very long texts are written whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm.common import read_table, ship

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PART = (
    "struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>"
)
LEARNED_ROLE = "assistant"
ADDED = -7
ADDED_TEXT = r"\### Assistant: </turn> ok"


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment is expanded to; unknown measures count as the least."""

    patch: int = 28  # pixels of a side of the square that one token stands for
    per_second: float = 25.0
    per_page: int = 1024

    def image(self, part: dict) -> int:
        sides = (max(part["width"] or 1, 1), max(part["height"] or 1, 1))
        return math.prod(-(-side // self.patch) for side in sides)

    def audio(self, part: dict) -> int:
        return max(1, math.ceil((part["seconds"] or 0) * self.per_second))

    def document(self, part: dict) -> int:
        return max(1, part["pages"] or 1) * self.per_page


ATTACHED = ("image", "audio", "document")
_HEADER = r"<turn:((?:[^\\<>]|\\.)*)>\n"
_PLACEHOLDER = rf"<({'|'.join(ATTACHED)}) (\d+)>"
_END = "</turn>\n"
# Where a text would be read as a control string; the backslash itself always is.
_TO_ESCAPE = re.compile(rf"\\|<(?=turn:|/turn>|(?:{'|'.join(ATTACHED)}) \d)")
_TOKEN = re.compile(
    rf"(?P<escaped>\\.)|(?P<header>{_HEADER})|(?P<part>{_PLACEHOLDER})|(?P<end>{_END})", re.DOTALL
)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def header(role: str) -> str:
    return "<turn:" + re.sub(r"[\\<>]", r"\\\g<0>", role) + ">\n"


@dataclass
class Visitor:
    """Writes the turns of one conversation, one after another."""

    expansion: Expansion
    count_tokens: object = None
    attachments: int = 0
    written: int = 0  # code points of the segments before
    pieces: list[str] = field(default_factory=list)
    size: int = 0
    tokens: int = 0
    held: list[str] = field(default_factory=list)
    loss: list[tuple[int, int]] = field(default_factory=list)
    attached: list[dict] = field(default_factory=list)

    def _write(self, piece: str, tokens: int | None = None) -> None:
        self.pieces.append(piece)
        self.size += len(piece)
        if tokens is None:
            tokens = self.count_tokens(piece) if self.count_tokens else 0
        self.tokens += tokens

    def visit_text(self, part: dict) -> None:
        self.held.append(part["text"] or "")

    def _close_text(self, learned: bool) -> None:
        text = escape("".join(self.held))
        self.held.clear()
        if text:
            start = self.size
            self._write(text)
            if learned:
                self.loss.append((self.written + start, self.written + self.size))

    def _visit_attachment(self, part: dict, learned: bool) -> None:
        self._close_text(learned)
        kind, self.attachments = part["type"], self.attachments + 1
        tokens = getattr(self.expansion, kind)(part)
        self.attached.append(
            {
                "number": self.attachments,
                "type": kind,
                "ref": part["ref"],
                "start": self.written + self.size,
                "tokens": tokens,
            }
        )
        self._write(f"<{kind} {self.attachments}>", tokens)

    visit_image = visit_audio = visit_document = _visit_attachment

    def visit(self, part: dict, learned: bool) -> None:
        kind = part["type"]
        if kind == "text":
            self.visit_text(part)
        elif kind in ATTACHED:
            getattr(self, f"visit_{kind}")(part, learned)
        else:
            raise ValueError(f"no rule for parts of type {kind!r}")

    def turn(self, role: str, parts: list[dict]) -> dict:
        self.pieces, self.size, self.tokens, self.loss, self.attached = [], 0, 0, [], []
        self._write(header(role))
        learned = role == LEARNED_ROLE
        for part in parts:
            self.visit(part, learned)
        self._close_text(learned)
        self._write(_END)
        start, self.written = self.written, self.written + self.size
        return {
            "start": start,
            "segment": "".join(self.pieces),
            "loss": [{"start": s, "end": e} for s, e in self.loss],
            "attachments": self.attached,
            "n_tokens": self.tokens,
        }


@lru_cache(maxsize=2)
def _counter(path: str):
    """Tokens of a string by a ``tokenizers`` file, loaded once per worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = F.lit(None)
    named = (
        F.lit("text").alias("type"), text.alias("text"), null.alias("ref"), null.alias("width"),
        null.alias("height"), null.alias("seconds"), null.alias("pages"),
    )
    return F.array(F.struct(*named)).cast(f"array<{PART}>")


def parts_from_json(content: Column) -> Column:
    """Typed parts from JSON; text that is not a JSON list of parts is one text part.

    Parts are objects of ``type`` and the fields of ``PART`` that the type needs.
    """
    parts = F.from_json(content, f"array<{PART}>")
    known = F.exists(parts, lambda p: p["type"].isNotNull())
    return F.when(content.startswith("[") & known, parts).otherwise(text_part(content))


def _in_order(turns: DataFrame, parts: Column) -> DataFrame:
    """Conversations one after another, their turns in order, in as many tasks as shuffles have."""
    ship(turns.sparkSession)
    chosen = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        parts.alias("parts"),
    )
    # the parts themselves order turns of the same number and role
    return chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")


FORMATTED = (
    "conv_id long, turn long, position long, start long, segment string, "
    "loss array<struct<start:long,end:long>>, attachments array<struct<number:long,type:string,"
    "ref:string,start:long,tokens:long>>, n_tokens long"
)
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHMENTS = pa.list_(
    pa.struct(
        [
            ("number", pa.int64()),
            ("type", pa.string()),
            ("ref", pa.string()),
            ("start", pa.int64()),
            ("tokens", pa.int64()),
        ]
    )
)
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("position", pa.int64()),
        ("start", pa.int64()),
        ("segment", pa.string()),
        ("loss", _LOSS),
        ("attachments", _ATTACHMENTS),
        ("n_tokens", pa.int64()),
    ]
)


def format_turns(
    turns: DataFrame,
    content: str | None = None,
    tokenizer: str | None = TOKENIZER,
    expansion: Expansion = Expansion(),
) -> DataFrame:
    """One row per turn: its segment of the conversation's text and what is in it.

    ``content`` names a column of typed parts (array of ``PART``); without it, or where it is null,
    a turn is its ``text``. Offsets are code points of the conversation's whole text, which is its
    segments in the order of ``position``. ``n_tokens`` counts the segment with its placeholders
    expanded; without a tokenizer file it counts attachments only.
    """
    parts = text_part(F.col("text").cast("string"))
    if content:
        parts = F.coalesce(F.col(content).cast(f"array<{PART}>"), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = _counter(tokenizer) if tokenizer else None
        visitor, of, position = None, None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if visitor is None or row["conv_id"] != of:
                    visitor, of, position = Visitor(expansion, counted), row["conv_id"], 0
                said = visitor.turn(row["role"], row["parts"])
                out.append({"conv_id": of, "turn": row["turn"], "position": position, **said})
                position += 1
            yield pa.RecordBatch.from_pylist(out, _FORMATTED)

    return _in_order(turns, parts).mapInArrow(run, FORMATTED)


def joined(formatted: DataFrame) -> DataFrame:
    """Conversations as one cell each, for those that fit one: text, mask, attachments, tokens."""
    held = F.struct("position", "segment", "loss", "attachments", "n_tokens")
    rows = formatted.groupBy("conv_id").agg(F.array_sort(F.collect_list(held)).alias("rows"))
    return rows.select(
        "conv_id",
        F.concat_ws("", "rows.segment").alias("formatted"),
        F.flatten("rows.loss").alias("loss"),
        F.flatten("rows.attachments").alias("attachments"),
        F.aggregate("rows.n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
    )


def read_back(segment: str) -> Iterator[tuple[str, list[str | tuple[str, int]]]]:
    """Turns of a formatted text: role, and texts and (type, number) of attachments in order."""
    role, parts, text, at = None, [], [], 0
    for found in _TOKEN.finditer(segment):
        text.append(segment[at : found.start()])
        at = found.end()
        if found["escaped"]:
            text.append(found["escaped"][1])
            continue
        if (said := "".join(text)) and role is not None:
            parts.append(said)
        elif said:
            raise ValueError("text outside a turn")
        text = []
        if found["header"] is not None:
            role, parts = unescape(found[3]), []
        elif found["part"]:
            parts.append((found[5], int(found[6])))
        else:
            yield role, parts
            role = None
    if role is not None or at < len(segment):
        raise ValueError("the last turn has no end")


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long"
)


class _Digest:
    """What is read back of one conversation, turn after turn."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tokens = 0

    def add(self, segment: str, start: int, loss: list[dict], tokens: int) -> None:
        for role, parts in read_back(segment):
            text = "".join(p if isinstance(p, str) else f"<{p[0]} {p[1]}>" for p in parts)
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss:
            learned = unescape(segment[span["start"] - start : span["end"] - start])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(segment)
        self.tokens += tokens

    def row(self) -> list:
        return [
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars, self.tokens,
        ]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted turns, conversation by conversation: figures and digests of each."""
    names = [field.split(" ")[0] for field in DIGESTS.split(", ")]
    kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]

    def written(rows: list[list]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names
        )

    digest, of = None, None
    for batch in batches:
        out = []
        columns = [batch[c].to_pylist() for c in ("conv_id", "segment", "start", "loss", "n_tokens")]
        for conv_id, *turn in zip(*columns):
            if digest is None or conv_id != of:
                if digest:
                    out.append([of, *digest.row()])
                digest, of = _Digest(), conv_id
            digest.add(*turn)
        yield written(out)
    if digest:
        yield written([[of, *digest.row()]])


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns hold, read back from them.

    For rows as ``format_turns`` gives them: conversations are streamed in the order they come.
    """
    return formatted.mapInArrow(_digests, DIGESTS)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(ADDED, 0, "user", ADDED_TEXT), (ADDED, 1, LEARNED_ROLE, ADDED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return digests(format_turns(turns.unionByName(added)))
