"""Chat formatting by columnar byte assembly, with a loss mask, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.textbytes import buffers, slices

#: Bytes that begin a control string, or the escape itself: each is escaped by a backslash.
ESCAPED = b"\\<["
BEGIN = b"<s>"
#: Header and trailer of a turn by role; other roles carry their name.
TURN = {"user": (b"[INST] ", b" [/INST]"), "assistant": (b"", b"</s>"), "system": (b"<<SYS>>", b"<</SYS>>")}
OTHER = (b"[ROLE] %s [/ROLE]", b"[END]")
#: Text bytes assembled at once.
PIECE_BYTES = 8 << 20

PIECE = "piece long, formatted string, loss array<struct<start: long, stop: long>>"
BACK = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a backslash before each special byte, and their new offsets."""
    special = np.isin(data, np.frombuffer(ESCAPED, np.uint8))
    ends = np.zeros(len(data) + 1, np.int64)
    np.cumsum(1 + special.astype(np.int64), out=ends[1:])
    out = np.full(ends[-1], ord("\\"), np.uint8)
    out[ends[1:] - 1] = data
    return out, ends[offsets]


def _copy(out: np.ndarray, to: np.ndarray, src: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> None:
    """Copy segments src[begins : begins + lengths] to out[to : to + lengths], by index."""
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(to, lengths) + step] = src[np.repeat(begins, lengths) + step]


def _pool(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths


def _frames(roles: list[str]) -> list[tuple[bytes, bytes]]:
    def frame(role: str) -> tuple[bytes, bytes]:
        if role in TURN:
            return TURN[role]
        name = role.encode()
        return OTHER[0] % _escape(np.frombuffer(name, np.uint8), np.array([0, len(name)]))[0].tobytes(), OTHER[1]

    return [frame(r) for r in roles]


def _assemble(key: str):
    """Format turns that come ordered by conversation and turn; state is carried over batches."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = object(), 0
        for batch in slices(batches, "_text", PIECE_BYTES):
            ids = batch.column(key)
            codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
            n = len(codes)
            opens = np.ones(n, bool)
            opens[1:] = codes[1:] != codes[:-1]
            goes_on = ids[0].as_py() == last
            new = opens.copy()
            new[0] = not goes_on
            roles = pc.dictionary_encode(batch.column("_role"))
            role = roles.indices.to_numpy()
            names = roles.dictionary.to_pylist()
            frames = _frames(names)
            heads, head_at, head_n = _pool([h for h, _ in frames])
            tails, tail_at, tail_n = _pool([t for _, t in frames])
            body, body_at = _escape(*buffers(batch.column("_text")))
            body_n = np.diff(body_at)
            lead = np.where(new, len(BEGIN), 0)
            at = np.zeros(n + 1, np.int64)
            np.cumsum(lead + head_n[role] + body_n + tail_n[role], out=at[1:])
            out = np.empty(at[-1], np.uint8)
            begin = np.frombuffer(BEGIN, np.uint8)
            _copy(out, at[:-1], begin, np.zeros(n, np.int64), lead)
            _copy(out, at[:-1] + lead, heads, head_at[role], head_n[role])
            body_to = at[:-1] + lead + head_n[role]
            _copy(out, body_to, body, body_at[:-1], body_n)
            _copy(out, body_to + body_n, tails, tail_at[role], tail_n[role])
            first = np.flatnonzero(opens)
            cuts = at[np.append(first, n)]
            formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(cuts.tobytes()), pa.py_buffer(out))
            taught = np.flatnonzero(np.array([r == "assistant" for r in names], bool)[role])
            conv = np.cumsum(opens)[taught] - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(body_to[taught] - cuts[conv]), pa.array(body_to[taught] + body_n[taught] - cuts[conv])], ["start", "stop"]
            )
            per = np.searchsorted(conv, np.arange(len(first) + 1))
            numbers = np.zeros(len(first), np.int64)
            numbers[0] = piece + 1 if goes_on else 0
            last, piece = ids[n - 1].as_py(), int(numbers[-1])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first)), pa.array(numbers), formatted.cast(pa.string()), pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans)],
                [key, "piece", "formatted", "loss"],
            )

    return assemble


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``piece``, ``formatted`` and ``loss`` (byte ranges of assistant texts).

    A conversation longer than a batch comes in several pieces (numbered from 0, to be put
    together in order), so no conversation has to fit in memory. Turns are ordered by turn
    (null first), then role and text; equal rows are each a turn. Null text and null role are
    empty; rows with a null conversation id are one conversation. Other columns are not used.
    """
    ordered = (
        turns.select(F.col(conv), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"))
        .repartition(conv)
        .sortWithinPartitions(conv, "_turn", "_role", "_text")
    )
    kind = ordered.schema[conv].dataType.simpleString()
    return ordered.mapInArrow(_assemble(conv), f"`{conv}` {kind}, {PIECE}")


_TEXT = rb"((?:[^\\<\[]|\\.)*)"
_TURN = re.compile(
    rb"(?s)\[INST\] %(t)s \[/INST\]|<<SYS>>%(t)s<</SYS>>|\[ROLE\] %(t)s \[/ROLE\]%(t)s\[END\]|%(t)s</s>" % {b"t": _TEXT}
)
_UNESCAPE = re.compile(rb"(?s)\\(.)")


def _unescape(b: bytes) -> bytes:
    return _UNESCAPE.sub(rb"\1", b)


def _turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Roles and texts of a formatted piece."""
    at = len(BEGIN) if formatted.startswith(BEGIN) else 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None or found.end() == at:
            raise ValueError(f"no turn at byte {at}")
        at = found.end()
        user, system, name, other, assistant = found.groups()
        for role, body in ((b"user", user), (b"system", system), (b"assistant", assistant)):
            if body is not None:
                yield role, _unescape(body)
        if other is not None:
            yield _unescape(name), _unescape(other)


def _digest(key: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None

        def row():
            conv, n, turns, chars, loss, size = state
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([n]), pa.array([turns.hexdigest()]), pa.array([chars]), pa.array([loss.hexdigest()]), pa.array([size])],
                [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            kind = batch.schema.field(key).type
            for conv, text, spans in zip(batch.column(key).to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                if state is None or conv != last:
                    if state is not None:
                        yield row()
                    state, last = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                raw = text.encode()
                for name, body in _turns(raw):
                    state[1] += 1
                    state[2].update(name + b"\n" + body + b"\n")
                for s in spans:
                    taught = _unescape(raw[s["start"] : s["stop"]])
                    state[3] += len(taught.decode())
                    state[4].update(taught)
                state[5] += len(text)
        if state is not None:
            yield row()

    return digest


def read_back(pieces: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation: turns, digests of turns and of the text under the loss mask, as read from the output."""
    kind = pieces.schema[conv].dataType.simpleString()
    ordered = pieces.select(conv, "piece", "formatted", "loss").repartition(conv).sortWithinPartitions(conv, "piece")
    return ordered.mapInArrow(_digest(conv), f"`{conv}` {kind}, {BACK}")
