r"""Chat formatting with a grammar that is read back.

A conversation is written as its turns, each of them

    ### role:
    text
    </turn>

A deterministic parser reads the result. In a text, ``###`` and ``</turn>`` are control strings; with backslashes before
them they are text, and one backslash is taken away on reading. Texts are first written as they are. What the parser
recovers is compared to the source; turns that come back differently, or that it rejects, are written again with one
backslash more before each control string, until everything is identical. The loss mask holds the assistant's texts.

Turns are dealt out by conversation and sorted within tasks; a task streams through them and writes a conversation in
parts of at most ``PART_CHARS`` characters (or one turn), each checked on its own, so that no conversation has to fit in
memory. Parts of a conversation lie next to each other, in order: ``read_back`` relies on it and needs no shuffle.

Defined cases: a null text is empty, a null role is the empty role, rows without conversation are the conversation null;
turns are ordered by number (null first), then role, then text, and repeated rows are repeated turns; roles may hold any
characters; a conversation has one row or more, so an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.frames import inputs, partitions

OPEN, CLOSE = "### ", "\n</turn>\n"
LOSS_ROLE = "assistant"
PART_CHARS = 1 << 20
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ESCAPED = re.compile(r"\\(\\*(?:###|</turn>))")
_HEADER = re.compile(r"### ((?:[^\\:\n]|\\[\\:n])*):\n")
_ROLE_CODES = {"\\": "\\\\", ":": "\\:", "\n": "\\n"}
_ROLE_TEXTS = {code: text for text, code in _ROLE_CODES.items()}

Turn = tuple[str, str]


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[Turn], escaped: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text, and the spans of the assistant's texts in it, in code points."""
    out, spans, at = [], [], 0
    for k, (role, text) in enumerate(turns):
        header = OPEN + re.sub(r"[\\:\n]", lambda m: _ROLE_CODES[m[0]], role) + ":\n"
        body = escape(text) if k in escaped else text
        start = at + len(header)
        if role == LOSS_ROLE:
            spans.append((start, start + len(body)))
        out.append(header + body + CLOSE)
        at = start + len(body) + len(CLOSE)
    return "".join(out), spans


def parse(text: str) -> list[Turn]:
    """The turns; a GrammarError where the text is none."""
    turns, at = [], 0
    while at < len(text):
        header = _HEADER.match(text, at)
        if not header:
            raise GrammarError(f"no turn begins at {at}")
        mark = next((m for m in _CONTROL.finditer(text, header.end()) if not m[1]), None)
        if mark is None or not text.startswith(CLOSE, mark.start() - 1) or mark.start() - 1 < header.end():
            raise GrammarError(f"the turn at {at} does not end")
        role = re.sub(r"\\[\\:n]", lambda m: _ROLE_TEXTS[m[0]], header[1])
        turns.append((role, unescape(text[header.end() : mark.start() - 1])))
        at = mark.start() - 1 + len(CLOSE)
    return turns


def comes_back(turns: list[Turn], written: str) -> bool:
    try:
        return parse(written) == turns
    except GrammarError:
        return False


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """Text, loss spans and the number of escaped turns, the text reading back as exactly these turns."""
    escaped: set[int] = set()
    while True:
        text, spans = render(turns, escaped)
        if comes_back(turns, text):
            return text, spans, len(escaped)
        conflicting = {k for k, t in enumerate(turns) if k not in escaped and not comes_back([t], render([t], set())[0])}
        if not conflicting:
            raise GrammarError("escaped turns do not read back")
        escaped |= conflicting


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, formatted, loss, escaped)`` from rows of ``conv_id, turn, role, text``."""
    rows = inputs(turns, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )
    schema = "conv_id long, part int, formatted string, loss array<struct<start:int,end:int>>, escaped int"
    return ordered.select("conv_id", "role", "text").mapInArrow(_written, schema)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    loss = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = [pa.int64(), pa.int32(), pa.string(), loss, pa.int32()]
    names = ["conv_id", "part", "formatted", "loss", "escaped"]
    out: list[tuple] = []
    size = 0
    for conv_id, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
        for part, turns in enumerate(_parts(rows)):
            text, spans, escaped = format_turns(turns)
            out.append((conv_id, part, text, [{"start": a, "end": b} for a, b in spans], escaped))
            size += len(text)
            if size >= PART_CHARS:
                yield _batch(out, kinds, names)
                out, size = [], 0
    if out:
        yield _batch(out, kinds, names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _parts(rows: Iterator[tuple]) -> Iterator[list[Turn]]:
    turns, size = [], 0
    for _, role, text in rows:
        if turns and size + len(text) > PART_CHARS:
            yield turns
            turns, size = [], 0
        turns.append((role, text))
        size += len(text)
    if turns:
        yield turns


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from what ``format_chats`` wrote alone: turns, loss text and lengths as digests.

    The frame must hold a conversation's parts next to each other in order, as ``format_chats`` returns them.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_escaped"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv_id, parts in itertools.groupby(_rows(batches), key=lambda row: row[0]):
            turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = n_escaped = 0
            for _, _, text, spans, escaped in parts:
                turns = parse(text)
                for role, body in turns:
                    turns_hash.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    body = unescape(text[span["start"] : span["end"]])
                    loss_hash.update(body.encode())
                    loss_chars += len(body)
                n_turns, chars, n_escaped = n_turns + len(turns), chars + len(text), n_escaped + escaped
            digests = (turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest())
            out.append((conv_id, n_turns, *digests, chars, n_escaped))
            if len(out) >= 4096:
                yield _batch(out, kinds, names)
                out = []
        if out:
            yield _batch(out, kinds, names)

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
        " n_escaped long"
    )
    return formatted.select("conv_id", "part", "formatted", "loss", "escaped").mapInArrow(run, schema)
