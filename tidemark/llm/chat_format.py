"""Chat formatting by columnar byte assembly, with a loss mask and a way back.

A turn becomes ``### Role: text`` and a line ``</turn>``.  Inside texts a backslash goes before
every control string (a run of three or more ``#``, or ``</turn>``), so a control string after
a backslash is text and taking one backslash away gives the text again.

Rows are dealt out by ranges of (conversation, turn), so a conversation of many rows spreads over
many tasks.  A task turns a batch of rows into bytes at once: the lengths of all segments, their
cumulative offsets and the scatter indices are numpy arrays, and headers, texts and backslashes are
copied into one preallocated buffer that becomes the column of an Arrow batch.

A conversation that ends within its batch is one part; one that crosses batches or tasks is several
parts, whose texts follow each other in the order of ``part``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

# The template: fixed values.
OPEN, MIDDLE, CLOSE = b"### ", b": ", b"\n</turn>\n"
END = b"</turn>"
ASSISTANT = "assistant"

_ESCAPED = re.compile(rb"\\(#{3,}|</turn>)")
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*): ", re.S)


def role_bytes(role: str) -> bytes:
    """A role in a header: the case of its first letter swapped if it is A-Z, and backslashes before what would end it."""
    role = role[:1].swapcase() + role[1:] if role[:1].isascii() else role
    return re.sub(rb"([\\:#<\n])", rb"\\\1", role.encode())


def role_of(header: bytes) -> str:
    role = re.sub(rb"\\(.)", rb"\1", header, flags=re.S).decode()
    return role[:1].swapcase() + role[1:] if role[:1].isascii() else role


def control_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where control strings begin in ``data``, the texts of which end at ``ends``."""

    def same_text(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, a, "right") == np.searchsorted(ends, b, "right")

    hashes = np.flatnonzero(data == ord("#"))
    first = np.ones(len(hashes), bool)
    first[1:] = (np.diff(hashes) != 1) | ~same_text(hashes[1:], hashes[:-1])
    third = np.zeros(len(hashes), bool)
    third[:-2] = (hashes[2:] - hashes[:-2] == 2) & same_text(hashes[2:], hashes[:-2])
    found = np.flatnonzero(data == END[0])
    found = found[found + len(END) <= len(data)]
    for k in range(1, len(END)):
        found = found[data[found + k] == END[k]]
    found = found[same_text(found, found + len(END) - 1)]
    return np.sort(np.concatenate([hashes[first & third], found]))


def assembled(roles: list[str], texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns as one buffer; the end of each turn in it, and where each text begins and ends."""
    rows = list(base.byte_rows(texts))
    data = np.concatenate(rows) if rows else np.zeros(0, np.uint8)
    sizes = np.array([len(r) for r in rows], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = control_starts(data, ends)
    row_of = np.searchsorted(ends, marks, "right")
    added = np.bincount(row_of, minlength=len(rows)).astype(np.int64)

    codes: dict[str, int] = {}
    code = np.array([codes.setdefault(r, len(codes)) for r in roles], np.int64)
    kinds = [OPEN + role_bytes(r) + MIDDLE for r in codes]
    heads = np.array([len(k) for k in kinds], np.int64)[code] if rows else sizes

    turn_ends = np.cumsum(heads + sizes + added + len(CLOSE))
    turn_starts = turn_ends - heads - sizes - added - len(CLOSE)
    text_starts = turn_starts + heads
    text_ends = text_starts + sizes + added
    out = np.empty(int(turn_ends[-1]) if rows else 0, np.uint8)
    text = np.ones(len(out), bool)  # what is left after all else has its place is text, in order
    for k, kind in enumerate(kinds):
        at = (turn_starts[code == k][:, None] + np.arange(len(kind))).ravel()
        out[at] = np.tile(np.frombuffer(kind, np.uint8), len(at) // len(kind))
        text[at] = False
    at = (text_ends[:, None] + np.arange(len(CLOSE))).ravel()
    out[at] = np.tile(np.frombuffer(CLOSE, np.uint8), len(rows))
    text[at] = False
    # a mark moves by the start of its text and the marks before it in the same text
    before = np.arange(len(marks)) - (np.cumsum(added) - added)[row_of]
    at = text_starts[row_of] + (marks - starts[row_of]) + before
    out[at] = ord("\\")
    text[at] = False
    out[text] = data
    return out, turn_ends, text_starts, text_ends


_PART = "conv_id {id}, part long, whole boolean, n_turns long, formatted string, loss array<struct<start:long,end:long>>"


def _parts(batches) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their conversations and turns -> parts of conversations."""
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        ids, roles = batch.column("conv_id"), batch.column("role").fill_null("").to_pylist()
        out, turn_ends, text_starts, text_ends = assembled(roles, batch.column("text"))
        keys = ids.to_pylist()
        first = np.array([0] + [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], np.int64)
        last = np.append(first[1:], len(keys))
        edges = np.concatenate([[0], turn_ends[last - 1]])
        characters = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
        masked = np.flatnonzero(np.array(roles, object) == ASSISTANT)
        of = np.searchsorted(last, masked, "right")
        origin = characters[edges[:-1]][of]
        lists = np.searchsorted(of, np.arange(len(first) + 1)).astype(np.int32)
        loss = pa.ListArray.from_arrays(pa.array(lists), base.struct(start=pa.array(characters[text_starts[masked]] - origin), end=pa.array(characters[text_ends[masked]] - origin)))
        formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(out))
        inner = np.ones(len(first), bool)
        inner[[0, -1]] = False  # these may go on in another batch
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(first)), pa.array(np.full(len(first), (task << 33) + number)), pa.array(inner), pa.array(last - first), formatted, loss],
            names=["conv_id", "part", "whole", "n_turns", "formatted", "loss"],
        )


def formatted(conversations: DataFrame) -> DataFrame:
    """Parts of conversations: conv_id, part, whole, n_turns, formatted, loss.

    ``conversations`` has conv_id, turn, role and text; other columns are not looked at.  The turns
    of a conversation follow by turn (a null turn last), then role, then a hash of the text; equal
    rows are as many equal turns.  A null role or text is empty; a null conv_id is a conversation
    like any other.  ``loss`` has the spans of the assistant's texts in characters of ``formatted``.
    ``whole`` tells that a part is the whole of its conversation; without it, the parts of the
    conversation put together by ``part`` are.  No rows, no parts.

    The parts of one batch are one buffer; a text may be as long as a column's text (2 GB).
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    order = ["conv_id", F.asc_nulls_last("turn"), "role", "mark"]
    rows = rows.withColumn("mark", F.xxhash64("text"))
    # equal rows may lie on both sides of a border, so that no group of rows is bound to one task
    rows = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy")
    kind = dict(conversations.dtypes)["conv_id"]
    return rows.select("conv_id", "role", "text").mapInArrow(_parts, _PART.format(id=kind))


def turns_of(text: bytes) -> Iterator[tuple[str, bytes]]:
    """(role, text) of each turn of a formatted conversation."""
    at = 0
    while at < len(text):
        head = _TURN.match(text, at)
        end = text.index(CLOSE, head.end())
        yield role_of(head[1]), plain(text[head.end() : end])
        at = end + len(CLOSE)


def plain(text: bytes) -> bytes:
    """A text without the backslashes of the template."""
    return _ESCAPED.sub(rb"\1", text)


class Reading:
    """What the contract asks of one conversation, read back from its parts in order."""

    def __init__(self):
        self.turns = self.loss_characters = self.characters = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> Reading:
        raw = formatted.encode()
        for role, text in turns_of(raw):
            self.turns += 1
            self.all.update(role.encode() + b"\n" + text + b"\n")
        for span in spans:
            text = plain(formatted[span["start"] : span["end"]].encode())
            self.loss.update(text)
            self.loss_characters += len(text.decode())
        self.characters += len(formatted)
        return self

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_characters, self.loss.hexdigest(), self.characters


_DIGEST = "conv_id {id}, part long, whole boolean, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, formatted string, loss array<struct<start:long,end:long>>"
_FIELDS = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)]


def _read(batches) -> Iterator[pa.RecordBatch]:
    """Whole parts are read at once and lose their text; the others keep it."""
    for batch in batches:
        whole, texts, spans = (batch.column(c).to_pylist() for c in ("whole", "formatted", "loss"))
        rows = [Reading().add(t, s).row() if w else (None,) * len(_FIELDS) for w, t, s in zip(whole, texts, spans)]
        left = [batch.column("conv_id"), batch.column("part"), batch.column("whole")]
        rest = [pa.array([None if w else t for w, t in zip(whole, texts)], pa.string()), pa.array([None if w else s for w, s in zip(whole, spans)], batch.column("loss").type)]
        yield pa.RecordBatch.from_arrays(left + _columns(rows) + rest, names=["conv_id", "part", "whole", *_FIELDS, "formatted", "loss"])


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """Parts in the order of their conversation -> one row for each conversation."""
    open_, key, kind = None, None, None
    for batch in batches:
        kind = batch.column("conv_id").type
        ids, rows = [], []
        for row in batch.to_pylist():
            if open_ is not None and (row["whole"] or row["conv_id"] != key):
                ids.append(key)
                rows.append(open_.row())
                open_ = None
            if row["whole"]:
                ids.append(row["conv_id"])
                rows.append(tuple(row[f] for f in _FIELDS))
                continue
            key, open_ = row["conv_id"], (open_ or Reading()).add(row["formatted"], row["loss"])
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), *_columns(rows)], names=["conv_id", *_FIELDS])
    if open_ is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], kind), *_columns([open_.row()])], names=["conv_id", *_FIELDS])


def digested(parts: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``formatted``: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Whole parts are read where they are, and only their digests move.  The parts of the
    others meet in their order; a digest over a conversation needs them one after the other, and
    they are taken a batch at a time.
    """
    kind = dict(parts.dtypes)["conv_id"]
    read = parts.select("conv_id", "part", "whole", "formatted", "loss").mapInArrow(_read, _DIGEST.format(id=kind))
    met = read.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return met.mapInArrow(_joined, schema)
