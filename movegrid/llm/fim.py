"""Fill-in-middle: texts cut in three at unit boundaries, with the middle moved to the end.

The boundaries of a text (byte offsets where a unit ends) are kept as a compressed set in the manner
of Roaring bitmaps: a container per 65,536 offsets, each the smallest of an array of offsets, a
bitmap, or runs of consecutive offsets, and the cardinalities summed up before every container.
``select(k)`` searches the container in those sums and selects inside it, so both cuts of a text
cost two searches; ASCII text is a run per container, and no offsets are listed.

Cut places and forms follow from a hash of the document's id, so a repeated task makes the same rows.
Everything is one narrow stage; a text is held as its bytes and handled whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, fresh, rows_of, ship

SPAN = 1 << 16
PRE, SUF, MID = "<P>", "<S>", "<M>"
RATE, SPM = 90, 20                     # of 100 texts: those transformed, and of these the suffix-first ones
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _ends(data: np.ndarray, lo: int, hi: int, unit: str) -> np.ndarray:
    """Which offsets in [lo, hi), all over 0 and below len(data), end a unit: a code point, a word with the
    white space after it, or a line with its newline."""
    here = data[lo:hi]
    if unit == "char":
        return (here & 0xC0) != 0x80
    before = data[lo - 1:hi - 1]
    return before == 10 if unit == "line" else _SPACES[before] & ~_SPACES[here]


class Runs:
    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.starts = low[first].astype(np.uint16)
        self.before = np.append(first, len(low)).astype(np.int32)

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[i]) + k - int(self.before[i])


class Array:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class Bitmap:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[i:i + 1].view(np.uint8), bitorder="little")
        return 64 * i + int(np.flatnonzero(bits)[k - int(self.before[i])])


def container(low: np.ndarray):
    """The smallest form of a container's ascending offsets: 4 bytes a run, 2 an offset, or 8,192."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    sizes = 4 * len(first), 2 * len(low), SPAN // 8
    if sizes[0] <= min(sizes):
        return Runs(low, first)
    return Array(low) if sizes[1] < sizes[2] else Bitmap(low)


class Boundaries:
    """The unit ends of a text; ``len`` is the number of units."""

    def __init__(self, data: bytes, unit: str = "char"):
        raw, n = np.frombuffer(data, np.uint8), len(data)
        self.keys, self.parts, sums = [], [], [0]
        for base in range(0, n + 1 if n else 0, SPAN):
            lo, hi = max(base, 1), min(base + SPAN, n)
            low = np.flatnonzero(_ends(raw, lo, hi, unit)) + (lo - base) if hi > lo else np.zeros(0, np.int64)
            if base <= n < base + SPAN:
                low = np.append(low, n - base)
            if len(low):
                self.keys.append(base)
                self.parts.append(container(low))
                sums.append(sums[-1] + len(low))
        self.before = np.array(sums, np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The byte offset after the first ``k`` units, 0 <= k <= len(self)."""
        if k == 0:
            return 0
        i = int(np.searchsorted(self.before, k - 1, "right")) - 1
        return self.keys[i] + self.parts[i].select(k - 1 - int(self.before[i]))


def code_points(data: bytes) -> int:
    """Code points of UTF-8 bytes, counted a piece at a time."""
    raw = np.frombuffer(data, np.uint8)
    return sum(int(np.count_nonzero((raw[i:i + (1 << 20)] & 0xC0) != 0x80)) for i in range(0, len(raw), 1 << 20))


def cut(data: bytes, h: tuple[int, int, int, int], unit: str, marks: tuple[bytes, bytes, bytes], rate: int, spm: int) -> tuple:
    """(n, form, prefix code points, middle code points, output) of one text."""
    ends = Boundaries(data, unit)
    n = len(ends)
    if not data or h[2] % 100 >= rate or any(m in data for m in marks):
        return n, "plain", None, None, data
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, y = ends.select(a), ends.select(b)
    prefix, middle, suffix = data[:x], data[x:y], data[y:]
    counts = (a, b - a) if unit == "char" else (code_points(prefix), code_points(middle))
    pre, suf, mid = marks
    if h[3] % 100 < spm:
        return n, "spm", *counts, b"".join((suf, suffix, pre, prefix, mid, middle))
    return n, "psm", *counts, b"".join((pre, prefix, suf, suffix, mid, middle))


def uncut(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text again.  No mark is in the text, nor can one begin in a part and end in a mark, so the
    first place where a mark is found is the mark."""
    pre, suf, mid = marks
    if form == "plain":
        return output
    first, second = (suf, pre) if form == "spm" else (pre, suf)
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(mid, 1)
    return two + middle + one if form == "spm" else one + middle + two


def draws(doc_id, seed: str) -> list:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256 of ``seed:doc_id`` as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), unit: str = "char", seed: str = "1",
                   rate: int = RATE, spm: int = SPM, marks: tuple[str, str, str] = (PRE, SUF, MID)) -> DataFrame:
    """``docs`` (doc_id, text) cut for fill-in-middle training: the columns ``keep``, then n (units), form
    (plain, psm, spm), prefix_chars, middle_chars (code points; null if plain) and output.

    A null text counts as empty and an empty one stays plain, as does one that holds a mark.  Rows with the same id
    and text give the same rows; a null id is hashed as an empty string.  Columns of ``docs`` beside doc_id and text are
    not read unless kept; a kept column named like an added one raises ValueError.  An empty table gives no rows.
    ``marks`` are three different strings, none of which has an end that is its own or another's beginning.
    """
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    if set(keep) & set(added):
        raise ValueError(f"columns to keep are named like added ones: {sorted(set(keep) & set(added))}")
    if unit not in ("char", "word", "line"):
        raise ValueError(f"unknown unit {unit!r}")
    text, *hs = names = fresh(keep, "text", "h1", "h2", "h3", "h4")
    ship(docs.sparkSession)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias(text)
    src = docs.select(*keep, data, *(h.alias(a) for h, a in zip(draws(F.col("doc_id"), seed), hs)))
    schema = docs.select(*keep, F.lit(0).cast("long").alias("n"), F.lit("").alias("form"), F.lit(None).cast("long").alias("prefix_chars"),
                         F.lit(None).cast("long").alias("middle_chars"), F.lit(b"").alias("output")).schema
    own, signs = list(keep), tuple(m.encode() for m in marks)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = pa.schema([*(batch.schema.field(c) for c in own), pa.field("n", pa.int64()), pa.field("form", pa.string()),
                              pa.field("prefix_chars", pa.int64()), pa.field("middle_chars", pa.int64()), pa.field("output", pa.binary())])
            made = ((*r[:-5], *cut(r[-5], r[-4:], unit, signs, rate, spm)) for r in rows_of(batch, *own, *names, step=32))
            yield from batches(made, cols, lambda r: len(r[-1]))

    return src.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restore(cut_docs: DataFrame, marks: tuple[str, str, str] = (PRE, SUF, MID)) -> DataFrame:
    """``cut_docs`` (output, form, and any other columns, which stay) with the column ``restored``: the text
    rebuilt from output and form alone.  A column that is already named so is replaced."""
    own = [c for c in cut_docs.columns if c != "restored"]
    ship(cut_docs.sparkSession)
    src = cut_docs.select(*own).withColumn("output", F.col("output").cast("binary"))
    schema = src.withColumn("restored", F.lit(b"")).schema
    signs = tuple(m.encode() for m in marks)
    o, f = own.index("output"), own.index("form")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = pa.schema([*batch.schema, pa.field("restored", pa.binary())])
            made = ((*r, uncut(r[o], r[f], signs)) for r in rows_of(batch, *own, step=32))
            yield from batches(made, cols, lambda r: 2 * len(r[-1]))

    out = src.mapInArrow(run, schema)
    return out.withColumns({c: F.col(c).cast("string") for c in ("output", "restored")})


def digests(docs: DataFrame) -> DataFrame:
    """The contract's row per document: counts, form, and digests of the output and of the text rebuilt from it."""
    back = restore(fill_in_middle(docs))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
