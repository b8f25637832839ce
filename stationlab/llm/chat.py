r"""Chat formatting with typed content parts.

A turn is `### Role: content </turn>` and a line feed. Content is a list of parts; a visitor flattens
it: text is escaped, an image, audio or document part becomes a numbered placeholder such as
`<image:0>`, and its reference and the tokens it will expand to are recorded. Backslashes stand
before what could be read as template: `\`, `###`, `</turn>`, `<image:`, `<audio:`, `<document:`,
and in roles before `:` and line feeds too; removing them gives the text back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("image", "audio", "document")
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<number: int, type: string, ref: string, place: long, tokens: long>"
TURNS = (
    f"conv_id long, seq long, role string, formatted string, place long, loss_begin long,"
    f" loss_end long, tokens long, attachments array<{ATTACHMENT}>"
)

# Fixed values of the template.
OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
CONTROL = re.compile(r"\\|###|</turn>|<(?=(?:image|audio|document):)")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|<(?=(?:image|audio|document):)|[:\n]")
ESCAPED = re.compile(r"\\(.)", re.S)
PLACEHOLDER = re.compile(r"\\.|<(image|audio|document):(\d+)>", re.S)
TURN = re.compile(r"### ((?:\\.|[^\\:\n])*): (.*) </turn>\n\Z", re.S)

PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE, CHARS_PER_TOKEN = 14, 25.0, 256, 4


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


class Flattener:
    """Visits the parts of one conversation; numbers run through all its turns."""

    def __init__(self):
        self.count = 0

    def visit(self, part: dict, place: int) -> tuple[str, int, dict | None]:
        """(flat text, tokens, attachment) of a part that begins at a place."""
        kind = part.get("type")
        if kind in KINDS:
            tokens = getattr(self, f"visit_{kind}")(part)
            number, self.count = self.count, self.count + 1
            found = dict(number=number, type=kind, ref=part.get("ref"), place=place, tokens=tokens)
            return f"<{kind}:{number}>", tokens, found
        return self.visit_text(part)

    def visit_text(self, part: dict) -> tuple[str, int, None]:
        """Text, and every part of an unknown type, as its escaped text."""
        text = part.get("text") or ""
        return escape(text), math.ceil(len(text) / CHARS_PER_TOKEN), None

    def visit_image(self, part: dict) -> int:
        sides = [math.ceil((part.get(side) or 0) / PATCH) for side in ("width", "height")]
        return max(1, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> int:
        return max(1, math.ceil((part.get("seconds") or 0) * TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> int:
        return max(1, (part.get("pages") or 0) * TOKENS_PER_PAGE)


ATTACHMENT_TYPE = pa.struct(
    [("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())]
)
TURN_TYPES = pa.schema(
    [("conv_id", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
     ("place", pa.int64()), ("loss_begin", pa.int64()), ("loss_end", pa.int64()), ("tokens", pa.int64()),
     ("attachments", pa.list_(ATTACHMENT_TYPE))]
)
SUMMARY_TYPES = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as Arrow columns: whole numbers stay whole beside nulls."""
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per turn, of (conv_id, turn, role, parts): conv_id, seq, role, formatted, place (where
    it begins in its conversation), loss_begin and loss_end (the assistant's content there, else
    null), tokens (expanded), attachments.

    Turns follow `turn` (null first), then role and text. Null roles, parts and texts are empty; a
    null conv_id is a conversation; a table without turns gives none. Repeated rows are turns each. A conversation streams through one
    task turn by turn, so its length takes time and no memory. Other columns are not read.
    """

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seq, place, flattener = object(), 0, 0, Flattener()
        for batch in batches:
            rows = []
            for conv, role, parts in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "parts")]):
                if conv != current:
                    current, seq, place, flattener = conv, 0, 0, Flattener()
                role = role or ""
                text = f"{OPEN}{escape_role(role)}{COLON}"
                begin, tokens, found = place + len(text), 0, []
                for part in parts if parts is not None else ():
                    if part is None:
                        continue
                    flat, n, attachment = flattener.visit(part, place + len(text))
                    text, tokens = text + flat, tokens + n
                    if attachment:
                        found.append(attachment)
                end = place + len(text)
                text += CLOSE
                loss = (begin, end) if role == "assistant" else (None, None)
                rows.append((conv, seq, role, text, place, *loss, tokens, found))
                seq, place = seq + 1, place + len(text)
            if rows:
                yield batch_of(rows, TURN_TYPES)

    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            "role",
            F.col("parts").cast(f"array<{PART}>").alias("parts"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "parts")
    )
    return ordered.drop("turn").mapInArrow(form, TURNS)


def text_parts(text) -> object:
    """A text as a list of one text part."""
    fields = [F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text")]
    fields += [
        F.lit(None).cast(kind).alias(name)
        for name, kind in (
            ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"),
            ("pages", "int"),
        )
    ]
    return F.array(F.struct(*fields))


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, content still escaped) of one formatted turn."""
    found = TURN.match(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), found[2]


def plain_text(content: str) -> str:
    """Content with placeholders taken out and escapes undone."""
    return unescape(PLACEHOLDER.sub(lambda m: "" if m[1] else m[0], content))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted turns alone: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. Hashes run along the turns, so no task holds a conversation."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None

        def closed() -> list[tuple]:
            if state is None:
                return []
            return [(current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])]

        for batch in batches:
            done = []
            columns = ("conv_id", "formatted", "place", "loss_begin", "loss_end")
            for conv, text, place, begin, end in zip(*[batch.column(c).to_pylist() for c in columns]):
                if conv != current or state is None:
                    done += closed()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, content = parse_turn(text)
                said = f"{role}\n{plain_text(content)}\n"
                state[1].update(said.encode("utf-8", "surrogatepass"))
                if begin is not None:
                    loss = plain_text(text[begin - place : end - place])
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[0] += 1
                state[4] += len(text)
            if done:
                yield batch_of(done, SUMMARY_TYPES)
        if state is not None:
            yield batch_of(closed(), SUMMARY_TYPES)

    rows = formatted.select("conv_id", "seq", "formatted", "place", "loss_begin", "loss_end")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(read, SUMMARY)


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)
