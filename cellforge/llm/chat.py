"""Chat formatting with typed content parts.

A message is a role and an ordered list of parts: text, image, audio or document.  A
visitor flattens the parts into one string: text is escaped, and each attachment becomes a
numbered placeholder, for which it records the reference and the number of tokens that the
placeholder expands to.  Turns are marked as ``### role: ... </turn>``.

``\\``, ``#``, ``<`` and, in roles, ``:`` are written as ``\\b``, ``\\h``, ``\\l`` and
``\\c``, so no marker can occur in a text and ``read_back`` restores every part exactly.
The loss mask is a list of spans (code points of the formatted string) over the parts of
assistant turns, markers left out.

Defined cases: a null text is empty, a null role is the empty role, a message without parts
is an empty turn; turns are ordered by turn (null last), then role, then parts, so repeated
rows are repeated turns; an unknown part type is formatted as text if it has a text and as
a document if not; a null conversation id is a conversation; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
LOSS_ROLE = "assistant"

# Tokens that a placeholder expands to; the documented parameters of the visitor.
IMAGE_PATCH, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE = 28, 25, 256

RESULT = (
    "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:int,stop:int>>, "
    "attachments array<struct<number:int,turn:int,type:string,uri:string,tokens:long>>, n_tokens long"
)


def escape(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


def unescape(text: str) -> str:
    for plain, written in reversed(ESCAPES):
        text = text.replace(written, plain)
    return text


class PartVisitor:
    """Flattens the parts of one conversation, in order."""

    def __init__(self) -> None:
        self.attachments: list[dict] = []
        self.tokens = 0

    def visit(self, part: dict, turn: int) -> str:
        kind = part.get("type")
        if kind == "text" or kind not in ("image", "audio", "document") and part.get("text") is not None:
            return self.visit_text(part)
        return self.placeholder(part, kind if kind in ("image", "audio") else "document", turn)

    def visit_text(self, part: dict) -> str:
        text = part.get("text") or ""
        self.tokens += len(text.split())
        return escape(text)

    def placeholder(self, part: dict, kind: str, turn: int) -> str:
        tokens = getattr(self, f"{kind}_tokens")(part)
        number = len(self.attachments)
        self.attachments.append({"number": number, "turn": turn, "type": kind, "uri": part.get("uri"), "tokens": tokens})
        self.tokens += tokens
        return f"<|{kind}:{number}|>"

    @staticmethod
    def image_tokens(part: dict) -> int:
        return math.ceil((part.get("width") or 0) / IMAGE_PATCH) * math.ceil((part.get("height") or 0) / IMAGE_PATCH) or 1

    @staticmethod
    def audio_tokens(part: dict) -> int:
        return math.ceil((part.get("seconds") or 0) * AUDIO_PER_SECOND) or 1

    @staticmethod
    def document_tokens(part: dict) -> int:
        return (part.get("pages") or 1) * DOCUMENT_PER_PAGE


def format_conversation(turns: list[tuple[str, list[dict]]]) -> tuple[str, list[tuple[int, int]], PartVisitor]:
    """(formatted, loss spans, visitor) of ``(role, parts)`` turns."""
    visitor, out, spans, at = PartVisitor(), [], [], 0
    for n, (role, parts) in enumerate(turns):
        head = OPEN + escape(role or "").replace(":", "\\c") + AFTER_ROLE
        body = "".join(visitor.visit(p, n) for p in parts or [])
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + CLOSE)
        at += len(out[-1])
    return "".join(out), spans, visitor


def read_back(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """The turns of a formatted string: role and ``(type, text or number)`` parts."""
    turns = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, _, body = turn.removeprefix(OPEN).partition(AFTER_ROLE)
        pieces = re.split(r"<\|(image|audio|document):(\d+)\|>", body)
        parts = [("text", unescape(pieces[0]))]
        for kind, number, text in zip(pieces[1::3], pieces[2::3], pieces[3::3]):
            parts += [(kind, number), ("text", unescape(text))]
        turns.append((unescape(role.replace("\\c", ":")), [p for p in parts if p[0] != "text" or p[1]]))
    return turns


def format_chats(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parts array<PART>`` -> one row for each conversation: the
    formatted string, its loss spans, attachments and expanded tokens."""
    last = F.coalesce(F.col("turn"), F.lit((1 << 63) - 1))
    turn = F.struct(last.alias("turn"), F.col("role"), F.col("parts").cast(f"array<{PART}>").alias("parts"))
    grouped = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for conv, turns in zip(frame["conv_id"], frame["turns"]):
                listed = [(t["role"], [dict(p) for p in t["parts"] if p is not None] if t["parts"] is not None else []) for t in turns]
                text, spans, seen = format_conversation(listed)
                marks = [{"start": a, "stop": b} for a, b in spans]
                rows.append((conv, len(listed), text, marks, seen.attachments, seen.tokens))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "formatted", "loss_spans", "attachments", "n_tokens"])
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    return grouped.mapInPandas(build, RESULT)
