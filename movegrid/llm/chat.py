"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string, turn after turn::

    <|turn|>ROLE<|text|>TEXT<|end|>\\n

The three control strings are special tokens of the tokenizer, so token bounds always fall on
the bounds of a text.  In roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``:
no control string can arise there, and the change is undone exactly.  The string is encoded
once with offsets, and the sorted spans of the assistant's texts are intersected with the
sorted token spans by binary search, which gives the loss mask.

Rows are dealt by ranges of conversation and turn, so a conversation that holds a third of all rows
is sorted, rendered, encoded and masked by many tasks.  Each reads its range as a stream and hands
it on in segments of whole turns, so memory is bounded by a segment (or one turn).  Reading back
is done per segment, too; only the digests, which are sequential, are fed by one task per
conversation: of a conversation that is known to be whole in one segment they are made there.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import batches, rows_of, ship

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
SEGMENT = 1 << 18    # characters after which a segment is handed on
LOSS_ROLE = "assistant"
PREFIX = 64          # characters of role and text by which turns of one number are dealt
_turn = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.DOTALL)
_escaped = re.compile(r"\\([\\|])")
_workers: dict[str, object] = {}

SEGMENTS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                      ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary()), ("loss", pa.binary()), ("whole", pa.bool_())])
SEGMENTS_DDL = "conv_id long, segment long, n_turns long, formatted string, ids binary, starts binary, ends binary, loss binary, whole boolean"
PARTS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("turns", pa.binary()), ("loss_chars", pa.int64()),
                   ("loss", pa.binary()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_loss_tokens", pa.int64())])
PARTS_DDL = ("conv_id long, segment long, whole boolean, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long, "
             "n_tokens long, n_loss_tokens long")
READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                  ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_loss_tokens", pa.int64())])
READ_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
            "n_tokens long, n_loss_tokens long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A rendered turn and the span of its text in it; null role or text is empty."""
    head = f"{TURN}{escape(role or '')}{TEXT}"
    body = escape(text or "")
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def _worker(data: bytes):
    key = hashlib.sha256(data).hexdigest()
    if key not in _workers:
        from tokenizers import AddedToken, Tokenizer
        tok = Tokenizer.from_buffer(data)
        tok.no_padding()
        tok.no_truncation()
        tok.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (TURN, TEXT, END)])
        _workers[key] = tok
    return _workers[key]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for tokens inside a span; token starts, token ends and spans are sorted."""
    mask = np.zeros(len(starts), np.uint8)
    for a, b in spans:
        if a < b:
            mask[np.searchsorted(ends, a, "right"):np.searchsorted(starts, b, "left")] = 1
    return mask


def encode_segment(tok, text: str, spans: list[tuple[int, int]]) -> tuple[bytes, bytes, bytes, bytes]:
    """Packed ids, token starts, token ends (code points) and mask of a rendered segment."""
    got = tok.encode(text, add_special_tokens=False)
    at = np.array(got.offsets, "<u4").reshape(-1, 2)
    return (np.array(got.ids, "<u4").tobytes(), at[:, 0].tobytes(), at[:, 1].tobytes(), loss_mask(at[:, 0], at[:, 1], spans).tobytes())


def format_chat(turns: DataFrame, vocab: str) -> DataFrame:
    """Rendered, encoded and masked conversations, one row per segment, in order.

    ``turns`` has conv_id, turn, role, text (others are not read).  Rows of a conversation are
    ordered by turn, nulls first, ties by role and text; repeated rows stay; null conv_id is a
    conversation of its own.  ``segment`` grows along a conversation, with gaps; ``whole`` says that a
    segment is known to be all of its conversation.  ``ids``, ``starts``, ``ends`` are packed
    little-endian 32-bit, ``loss`` one byte per token.  ``vocab`` is a tokenizer file on the driver
    (broadcast).  Turns of one conversation with one number, and role and text alike in their first
    ``PREFIX`` characters, stay in one task.
    """
    spark = turns.sparkSession
    ship(spark)
    with open(vocab, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _worker(shared.value)

        def segments():
            at = TaskContext.get().partitionId() << 33      # ranges are in order, so are their segments
            conv, n, first, held, size, spans = None, 0, True, [], 0, []

            def segment(whole):
                text = "".join(held)
                return (conv, at, len(held), text, *encode_segment(tok, text, spans), whole)

            for batch in it:
                for conv_id, role, text in rows_of(batch, "conv_id", "role", "text"):
                    if held and (conv_id != conv or size >= SEGMENT):
                        ended = conv_id != conv
                        yield segment(ended and n == 0 and not first)
                        n, first, at, held, size, spans = 0 if ended else n + 1, first and not ended, at + 1, [], 0, []
                    conv = conv_id
                    turn, a, b = render(role, text)
                    if role == LOSS_ROLE:
                        spans.append((size + a, size + b))
                    held.append(turn)
                    size += len(turn)
            if held:
                yield segment(False)

        yield from batches(segments(), SEGMENTS, lambda r: 3 * len(r[3]) + 3 * len(r[4]))

    return ordered.mapInArrow(run, SEGMENTS_DDL)


def masked_text(formatted: str, starts: bytes, ends: bytes, loss: bytes) -> Iterator[str]:
    """Texts under the mask, unescaped, a run of masked tokens at a time."""
    a, b, on = np.frombuffer(starts, "<u4"), np.frombuffer(ends, "<u4"), np.frombuffer(loss, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    for i, j in edge.reshape(-1, 2).tolist():
        yield unescape(formatted[int(a[i]):int(b[j - 1])])


def read_chat(segments: DataFrame) -> DataFrame:
    """Per conversation, read from the output of ``format_chat`` alone: turns, text under the mask
    and sizes.  Segments are read where they lie; what several of a conversation hold meets in order."""
    def read(it):
        def parts():
            for batch in it:
                for conv_id, segment, whole, formatted, starts, ends, loss in rows_of(batch, "conv_id", "segment", "whole", "formatted", "starts", "ends", "loss", step=16):
                    turns = [f"{unescape(m[1])}\n{unescape(m[2])}\n" for m in _turn.finditer(formatted)]
                    said = "".join(masked_text(formatted, starts, ends, loss))
                    out = "".join(turns).encode(), said.encode()
                    if whole:
                        out = [hashlib.sha256(x).hexdigest().encode() for x in out]
                    yield conv_id, segment, whole, len(turns), out[0], len(said), out[1], len(formatted), len(loss), loss.count(1)

        yield from batches(parts(), PARTS, lambda r: len(r[4]) + len(r[6]))

    def digest(it):
        def conversations():
            rows = (r for batch in it for r in rows_of(batch, *PARTS.names, step=16))
            for conv_id, own in groupby(rows, itemgetter(0)):
                turns, said, sums = hashlib.sha256(), hashlib.sha256(), [0] * 5
                for _, _, whole, n, text, chars, loss, size, tokens, on in own:
                    if whole:
                        yield conv_id, n, text.decode(), chars, loss.decode(), size, tokens, on
                        break
                    turns.update(text)
                    said.update(loss)
                    sums = [a + b for a, b in zip(sums, (n, chars, size, tokens, on))]
                else:
                    yield conv_id, sums[0], turns.hexdigest(), sums[1], said.hexdigest(), *sums[2:]

        yield from batches(conversations(), READ, lambda r: 200)

    dealt = segments.mapInArrow(read, PARTS_DDL).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return dealt.mapInArrow(digest, READ_DDL)
