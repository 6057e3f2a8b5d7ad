"""Chat formatting by columnar byte assembly.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings in a text or role cannot be
mistaken for the template: ``<`` followed by any number of backslashes and ``|`` gets one backslash
more, which is taken away on reading; so ``<|`` occurs in the output only where the template put
it. A role's line breaks are escaped as well.

Turns are assembled batch by batch: the lengths of all segments, their cumulative offsets and the
scatter indices are numpy arrays, and headers and contents are copied into one preallocated buffer
that becomes the Arrow column. The loss mask is a span of bytes in each turn (the text of an
assistant). Conversations are only put together where something about a whole one is asked for;
they are then read in order as a stream, so that no conversation is held, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm import common

common.by_value(__name__)

START, AFTER_ROLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
_DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long")


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\\\|", r"<\1|")


def escape_role(roles: pa.Array) -> pa.Array:
    """Escaped, on one line: ``%`` and line feeds percent-encoded."""
    return pc.replace_substring(pc.replace_substring(escape(roles), "%", "%25"), "\n", "%0A")


def unescape_role(roles: pa.Array) -> pa.Array:
    return unescape(pc.replace_substring(pc.replace_substring(roles, "%0A", "\n"), "%25", "%"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, length) of each value, and the bytes they are in."""
    flat = column.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    return offsets[:-1], np.diff(offsets), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns, and the span of the text within each."""
    n = len(texts)
    fixed = [np.frombuffer(b, np.uint8) for b in (START, AFTER_ROLE, END)]
    role_at, role_size, role_bytes = _bytes(escape_role(roles.fill_null("")))
    text_at, text_size, text_bytes = _bytes(escape(texts.fill_null("")))
    sizes = np.stack([np.full(n, len(fixed[0])), role_size, np.full(n, len(fixed[1])), text_size,
                      np.full(n, len(fixed[2]))], axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    begins = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for segment, content in ((0, fixed[0]), (2, fixed[1]), (4, fixed[2])):
        out[begins[:, segment, None] + np.arange(len(content))] = content
    for segment, at, size, data in ((1, role_at, role_size, role_bytes), (3, text_at, text_size, text_bytes)):
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begins[:, segment], size) + within] = data[np.repeat(at, size) + within]
    offsets = np.concatenate([[0], ends[:, -1]]) if n else np.zeros(1, np.int64)
    column = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    first = begins[:, 3] - offsets[:-1]
    return column.cast(pa.string()), first, first + sizes[:, 3]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, texts = batch.column("_role"), batch.column("_text")
        column, first, last = assemble(roles, texts)
        learn = pc.fill_null(pc.equal(roles, "assistant"), False)
        names = ["formatted", "loss_start", "loss_end"]
        spans = [pc.if_else(learn, pa.array(edge.astype(np.int32)), pa.scalar(0, pa.int32())) for edge in (first, last)]
        kept = [c for c in batch.schema.names if c not in ("_role", "_text")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [column, *spans], kept + names)


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv_id``, ``turn`` and ``tie`` of each row with ``formatted`` and the loss span in bytes.

    Rows are formatted where they are, without a shuffle. A null text or role is empty; every
    row stays, repeated ones too. ``tie`` orders rows of the same turn.
    """
    rows = common.tuned(turns).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.xxhash64(role, text).alias("tie"), F.col(role).cast("string").alias("_role"), F.col(text).alias("_text"))
    return rows.mapInArrow(_format, "conv_id long, turn long, tie long, formatted string, loss_start int, loss_end int")


def read_turns(formatted: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Roles and texts that formatted turns hold; ValueError where one is no turn."""
    parts = pc.extract_regex(formatted, r"(?s)\A<\|im_start\|>(?P<role>[^\n]*)\n(?P<text>.*)<\|im_end\|>\n\z")
    if parts.null_count:
        raise ValueError("not a formatted turn")
    return unescape_role(parts.field("role")), unescape(parts.field("text"))


class _Conversation:
    """What has been read of one conversation."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in
                        (c.split() for c in _DIGESTS.split(", "))])
    now: _Conversation | None = None
    for batch in batches:
        formatted = batch.column("formatted")
        roles, texts = (c.to_pylist() for c in read_turns(formatted))
        raw = formatted.cast(pa.binary()).to_pylist()
        spans = zip(batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist())
        learnt = unescape(pa.array([r[a:b] for r, (a, b) in zip(raw, spans)], pa.binary()).cast(pa.string())).to_pylist()
        done = []
        for conv_id, role, text, loss, size in zip(batch.column("conv_id").to_pylist(), roles, texts, learnt,
                                                   pc.utf8_length(formatted).to_pylist()):
            if now is None or now.conv_id != conv_id:
                done += [now.row()] if now else []
                now = _Conversation(conv_id)
            now.turns += 1
            now.all.update(f"{role}\n{text}\n".encode())
            now.loss.update(loss.encode())
            now.loss_chars += len(loss)
            now.chars += size
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now:
        yield pa.RecordBatch.from_pylist([now.row()], schema)


def digests(formatted: DataFrame) -> DataFrame:
    """A row per conversation, read back from its formatted turns in the order of (turn, tie).

    Turns without an id make one conversation. Rows of a conversation arrive as a sorted stream;
    a task holds two running hashes, not the conversation.
    """
    rows = common.tuned(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie")
    return rows.mapInArrow(_digest, _DIGESTS)
