"""Chat formatting with typed content parts.

A turn's content is a list of typed parts (text, image, audio, document). A visitor flattens them in
order: text is escaped, any other part becomes a placeholder and an attachment record with its reference
and the tokens that it expands to. The template marks conversations, roles and texts with control
strings; the same strings inside texts and roles are escaped, so that the formatted text can be read
back exactly, attachments included.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The template's own marks, and control strings of common chat templates, none of which
# may stand unescaped in a formatted text other than as a mark.
TURN, BODY, END, PLACE = "<|turn|>", "<|body|>", "<|end|>", "<|{kind}|>"
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

# Tokens that one placeholder of a kind expands to where the part does not say.
EXPANDED = {"image": 576, "audio": 128, "document": 512}

PART = "struct<type:string,text:string,ref:string,tokens:bigint>"

# First characters of control strings, those that overlap too, and backslashes.
_MEET = re.compile("|".join([r"\\", *[f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL]]))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    re.escape(TURN) + r"((?:[^<\\]|\\.|<(?!\|))*)" + re.escape(BODY) + r"((?:[^<\\]|\\.|<(?!\|end\|>))*)" + re.escape(END),
    re.S,
)
_PLACE = re.compile(r"<\|(image|audio|document)\|>")


def escape(text: str) -> str:
    """Break every control string with a backslash after its first character; double backslashes.

    Where two overlap, as in `<|>`, both are broken, so none is left in the result.
    """
    return _MEET.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    # The character before a breaking backslash stands for itself; a doubled backslash stands for one.
    return _ESCAPED.sub(lambda m: m[1], text)


class Flattener:
    """Visitor of content parts: collects the flat text and the attachments."""

    def __init__(self):
        self.flat: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.flat.append(escape(part.get("text") or ""))

    def visit_attachment(self, part: dict) -> None:
        kind, tokens = part["type"], part.get("tokens")
        self.attachments.append({
            "place": len(self.attachments), "kind": kind, "ref": part.get("ref"),
            "tokens": EXPANDED[kind] if tokens is None else int(tokens),
        })
        self.flat.append(PLACE.format(kind=kind))

    visit_image = visit_audio = visit_document = visit_attachment

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"a content part has the unknown type {part['type']!r}")


def parts_of(text: str | None) -> list[dict]:
    """A plain text as its only part."""
    return [{"type": "text", "text": text or ""}]


def format_turns(turns: list[tuple[str | None, list[dict] | None]]) -> tuple[str, list[dict]]:
    """The formatted conversation and its attachments, in order."""
    visitor, out = Flattener(), []
    for role, parts in turns:
        visitor.flat = []
        for part in parts or []:
            visitor.visit(part)
        out.append(TURN + escape(role or "") + BODY + "".join(visitor.flat) + END)
    return "".join(out), visitor.attachments


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, flat text) of each turn, unescaped; placeholders stay in the text as their marks."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a formatted conversation at {at}")
        pieces = _PLACE.split(m[2])
        flat = "".join(unescape(x) if k % 2 == 0 else PLACE.format(kind=x) for k, x in enumerate(pieces))
        out.append((unescape(m[1]), flat))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return out


def loss_spans(formatted: str) -> list[tuple[int, int]]:
    """(start, end) in code points of the texts that a model learns: what assistants say."""
    return [m.span(2) for m in _TURN.finditer(formatted) if unescape(m[1]) == "assistant"]


FORMATTED = (
    "conv_id bigint, n_turns bigint, formatted string, loss_spans array<struct<start:bigint,end:bigint>>, "
    "attachments array<struct<place:bigint,kind:string,ref:string,tokens:bigint>>, attachment_tokens bigint"
)


def format_conversations(
    rows: DataFrame, content: Column | None = None, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One formatted text per conversation, with its loss mask and attachments.

    `content` is a column of array<PART>; without it the text column is the only part. Turns go by
    number, nulls first; equal numbers by role and then content, and repeated rows are all kept. A null
    role or text is empty. Rows without a conversation id form one conversation. Other columns are not
    read. An empty table gives no rows. A conversation is one output row, so it is one task's work
    by nature; the shuffle carries each turn once.
    """
    text = F.col(text_column)
    whole = content if content is not None else F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens"),
    ))
    turn = F.struct(
        F.col(turn_column).alias("turn"), F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        whole.cast(f"array<{PART}>").alias("parts"),
    )
    talks = rows.select(F.col(id_column).cast("bigint").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))

    def run(batches):
        for batch in batches:
            out = []
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                formatted, attached = format_turns([(t["role"], t["parts"]) for t in turns])
                spans = [{"start": a, "end": b} for a, b in loss_spans(formatted)]
                out.append({
                    "conv_id": conv, "n_turns": len(turns), "formatted": formatted, "loss_spans": spans,
                    "attachments": attached, "attachment_tokens": sum(a["tokens"] for a in attached),
                })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_schema())

    return talks.mapInArrow(run, FORMATTED)


def _schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    attached = pa.struct([("place", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
    return pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(span)),
        ("attachments", pa.list_(attached)), ("attachment_tokens", pa.int64()),
    ])


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted text and loss mask."""
    def run(batches):
        for batch in batches:
            out = []
            for conv, text, spans in zip(*[batch.column(c).to_pylist() for c in ["conv_id", "formatted", "loss_spans"]]):
                turns = read_back(text)
                said = hashlib.sha256("".join(f"{role}\n{flat}\n" for role, flat in turns).encode())
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                out.append((conv, len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                    names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                )

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )


def parse_parts(text: str) -> list[dict]:
    """Content parts from their JSON form, for tables that store them as text."""
    return json.loads(text)
