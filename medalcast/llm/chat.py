"""Chat formatting by columnar byte assembly, with a loss mask.

A turn becomes ``### <role>: <text></turn>\\n``. Control strings inside texts
and roles are escaped by a backslash, which is itself doubled, so a formatted
conversation reads back exactly. The loss mask covers each assistant text (as
escaped) and nothing else.

Rows are dealt by ranges of (conversation, turn) and sorted inside each task;
they stream through in batches. A batch is assembled without a Python string per
turn: segment lengths (header, role, separator, text, tail) give cumulative
offsets, the offsets give scatter indices, and all bytes are copied into one
preallocated buffer that becomes the Arrow column. One conversation in one
batch is one output row; a conversation of any length comes in several parts
(``part`` 0, 1, ...), each whole turns, so no conversation is held at once.

Cases: a null text or role is empty; turns of a conversation sort by turn
(nulls first), then role and text, so ties have one result; repeated rows are
repeated turns. Null conversation ids form one conversation. An empty table
gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

# --- fixed values: the template ---
HEAD, SEP, TAIL = b"### ", b": ", b"</turn>\n"
CONTROL = ["### ", "</turn>"]          # escaped inside texts
ROLE_CONTROL = [*CONTROL, ": "]        # and inside roles
LOSS_ROLE = b"assistant"
_TOKEN = re.compile(r"\\(.)", re.S)


def escape(col: pa.Array, control: list[str]) -> pa.Array:
    """Backslashes doubled, and a backslash put before each control string; null is empty."""
    out = pc.fill_null(col.cast(pa.string()), "")
    out = pc.replace_substring(out, "\\", "\\\\")
    for c in control:
        out = pc.replace_substring(out, c, "\\" + c)
    return out


def unescape(text: str) -> str:
    return _TOKEN.sub(r"\1", text)


def assemble(segments: list[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate row by row the given columns of (bytes, offsets); a constant has offsets [0, len].

    Returns (buffer, where each segment of each row begins, [rows, segments + 1]).
    """
    lengths = np.stack([np.full(rows, off[1] - off[0]) if len(off) == 2 and rows != 1 else np.diff(off) for _, off in segments], axis=1)
    ends = np.cumsum(lengths.ravel())
    at = np.concatenate([[0], ends])
    out = np.empty(int(at[-1]), np.uint8)
    k = len(segments)
    for s, (data, off) in enumerate(segments):
        dest = at[s:-1:k]                          # where this segment of each row begins
        if len(off) == 2 and rows != 1:            # a constant: its bytes at every place
            out[(dest[:, None] + np.arange(off[1])[None, :]).ravel()] = np.tile(data, rows)
        else:
            n = int(off[-1])
            out[np.arange(n) + np.repeat(dest - off[:-1], np.diff(off))] = data[:n]
    return out, np.concatenate([at[:-1].reshape(rows, k), at[k::k][:, None]], axis=1)


def _constant(b: bytes):
    return np.frombuffer(b, np.uint8), np.array([0, len(b)])


def format_batch(ids: np.ndarray, role: pa.Array, text: pa.Array):
    """(first row of each conversation run, formatted bytes, their offsets, loss spans in code points per run)."""
    n = len(ids)
    r, t = tv.utf8(escape(role, ROLE_CONTROL)), tv.utf8(escape(text, CONTROL))
    buf, at = assemble([_constant(HEAD), r, _constant(SEP), t, _constant(TAIL)], n)
    runs = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    off = np.append(at[runs, 0], len(buf))
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    loss = np.asarray(pc.equal(pc.fill_null(role.cast(pa.string()), ""), LOSS_ROLE.decode()))
    lo, hi = chars[at[:, 3]], chars[at[:, 4]]
    base = chars[off[:-1]]
    run_of = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, n)))
    pick = np.flatnonzero(loss)
    spans = np.stack([lo[pick] - base[run_of[pick]], hi[pick] - base[run_of[pick]]], axis=1).ravel()
    counts = np.bincount(run_of[pick], minlength=len(runs))
    return runs, buf, off, np.concatenate([[0], np.cumsum(2 * counts)]), spans


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, part, text, loss_spans): formatted conversations, in turn order; parts of one stand together.

    ``loss_spans`` are flat code point ranges of ``text`` that train.
    """
    src = turns.select(F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").alias("n"),
                       F.col(f"`{role_col}`").cast("string").alias("r"), F.col(f"`{text_col}`").cast("string").alias("t"))
    src = src.repartitionByRange("c", "n").sortWithinPartitions("c", "n", "r", "t")

    def run(batches: Iterator[pa.RecordBatch]):
        last, part = object(), 0
        ahead = TaskContext.get().partitionId() << 33      # ranges ascend, so parts of one conversation do
        for b in batches:
            buf, off = tv.utf8(b.column(3))
            for i, j in tv.slices(off, 4 * tv.PIECE):
                s = b.slice(i, j - i)
                valid = s.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = s.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                mark = np.stack([ids, valid], axis=1).view([("i", ids.dtype), ("v", ids.dtype)]).ravel()
                runs, out, at, span_at, spans = format_batch(mark, s.column(2), s.column(3))
                parts = np.full(len(runs), ahead)
                first = (int(ids[0]), bool(valid[0]))
                if first == last:
                    parts[0] = part + 1
                part, last = int(parts[-1]), (int(ids[-1]), bool(valid[-1]))
                text = pa.StringArray.from_buffers(len(runs), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out))
                yield pa.RecordBatch.from_arrays(
                    [s.column(0).take(pa.array(runs)), pa.array(parts), text,
                     pa.ListArray.from_arrays(pa.array(span_at.astype(np.int32)), pa.array(spans.astype(np.int64)))],
                    names=["conv_id", "part", "text", "loss_spans"])
    return src.mapInArrow(tv.lean(run), "conv_id long, part long, text string, loss_spans array<long>")


_TURN = re.compile(r"### ((?:[^\\:]+|\\.|:(?! ))*): ((?:[^\\<]+|\\.|<(?!/turn>))*)</turn>\n", re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted part; raises if it isn't one."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: one row per conversation with counts and digests of turns and of the loss text.

    Parts are sorted inside their task and hashed as they come, so a long conversation costs no memory.
    """
    src = formatted.select("conv_id", "part", "text", "loss_spans").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches):
        state, key = None, object()
        for b in batches:
            done = []
            for conv, text, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "text", "loss_spans")), strict=True):
                if conv != key or state is None:
                    if state is not None:
                        done.append(_closed(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for lo, hi in zip(spans[::2], spans[1::2], strict=True):
                    said = unescape(text[lo:hi])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if done:
                yield _batch(done)
        if state is not None:
            yield _batch([_closed(key, state)])

    def _closed(conv, s):
        return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    def _batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    return src.mapInArrow(tv.lean(run), schema)
