"""Exact substring dedup by seed and extend.

Every ``width`` consecutive words (a window) have one seed: the first of their least ``k``-gram
hashes (winnowing).  The seed depends on the window's words only, so equal windows meet on equal
seeds, and the windows that own one seed occurrence are neighbours: its *extent*.

1. *Join on seeds.*  One row per seed occurrence, with a hash of its whole extent, is sorted by
   (seed, extent).  Occurrences with equal extents repeat each other to both sides as far as
   their windows reach: all their words are covered.  This settles the inside of every repeat.
2. *Extend.*  Where one seed has different extents a repeat ends somewhere around it.  One
   occurrence of each extent is followed window by window to both sides: its windows are joined
   on (seed, window hash), and each that occurs elsewhere is covered.  Pairs are never formed,
   so a passage shared by n documents costs n rows.
3. *Keep.*  A document's covered words are merged to maximal repeats and cut out.

Window equality is equality of two 64-bit hashes, of the seed and of the window.  Both are made from the
64-bit hashes of the words, so two words of one hash would make windows equal that differ in them only.

Hot seeds are split: seeds met unusually often on every 16th document (estimated, at most
``MOST_HOT`` of them, so they may be broadcast) are salted over many tasks.  Inside a salt
equal extents are settled as above; one occurrence of each extent and salt goes on to step 2,
whose windows are again compared first within a salt and then, one per salt, across salts.
The result does not depend on which seeds are called hot.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches, beside, materialize, rows_of, shielded, ship

PIECE = 1 << 17        # words hashed at once
BLOCK = 1 << 15        # windows whose seeds are found at once
MOST_HOT = 10_000      # hot seeds at most
LEAST_HOT = 1_000      # a seed met less often is not hot
SHARE = 16             # of the documents, on which hot seeds are looked for

MIX = np.uint64(0x9E3779B97F4A7C15)
SEEDS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("seed", pa.int64()), ("extent", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
FOUND = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("seed", pa.int64()), ("salts", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("whole", pa.bool_())])
WINDOWS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("seed", pa.int64()), ("salts", pa.int32()), ("win", pa.int64()), ("at", pa.int32())])
MET = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("seed", pa.int64()), ("win", pa.int64()), ("at", pa.int32()), ("again", pa.bool_())])
DDL = {"SEEDS": "id long, th long, seed long, extent long, lo int, hi int",
       "FOUND": "id long, th long, seed long, salts int, lo int, hi int, whole boolean",
       "WINDOWS": "id long, th long, seed long, salts int, win long, at int",
       "MET": "id long, th long, seed long, win long, at int, again boolean"}


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = ((a << np.uint64(7)) + (a >> np.uint64(11)) ^ b) * MIX
    return (x ^ (x >> np.uint64(29))) * MIX


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k`` consecutive values, by doubling (the last two parts may overlap)."""
    out, n = h, 1
    while n < k:
        step = min(n, k - n)
        m = len(h) - n - step + 1
        out, n = mix(out[:m], out[step:step + m]), n + step
    return out


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), "<u8", len(words))


def pieces(docs: Iterator[tuple], width: int) -> Iterator[tuple[list[tuple], np.ndarray]]:
    """Documents (*key, text) as flat word hashes, about ``PIECE`` words at a time: the parts
    (document, place of its first word, offset in the document, words) and the hashes.  Long
    documents come in parts that overlap by ``width - 1`` words, so each window is in one part."""
    parts, words = [], []
    for doc in docs:
        own = words_of(doc[-1])
        for i in range(0, max(1, len(own) - width + 1), PIECE):
            part = own[i:i + PIECE + width - 1]
            if len(part) < width:
                continue
            parts.append((doc, len(words), i, len(part)))
            words += part
            if len(words) >= PIECE:
                yield parts, hash_words(words)
                parts, words = [], []
    if parts:
        yield parts, hash_words(words)


def window_starts(parts: list[tuple], width: int) -> np.ndarray:
    return np.concatenate([np.arange(at, at + n - width + 1) for _, at, _, n in parts])


def seeds_of(parts: list[tuple], hashes: np.ndarray, width: int, k: int) -> pa.RecordBatch:
    """One row per seed occurrence: key, seed, extent hash, first and last window it owns."""
    gram, win = grams(hashes, k), grams(hashes, width)
    starts = window_starts(parts, width)
    part = np.repeat(np.arange(len(parts)), [n - width + 1 for *_, n in parts])
    view = np.lib.stride_tricks.sliding_window_view(gram, width - k + 1)
    own = np.concatenate([starts[i:i + BLOCK] + np.argmin(view[starts[i:i + BLOCK]], axis=1) for i in range(0, len(starts), BLOCK)])
    first = np.flatnonzero(np.concatenate([[True], (np.diff(own) != 0) | (np.diff(part) != 0)]))
    last = np.concatenate([first[1:], [len(own)]]) - 1
    shape = (own[first] - starts[first]).astype("u8") << np.uint64(32) | (last - first).astype("u8")
    extent = mix(np.add.reduceat(mix(win[starts], MIX), first), shape)
    begin = np.array([at for _, at, _, _ in parts])[part[first]]
    offset = np.array([i for _, _, i, _ in parts])[part[first]]
    lo, hi = starts[first] - begin + offset, starts[last] - begin + offset
    ids, ths = (np.array([d[c] for d, *_ in parts], np.int64)[part[first]] for c in (0, 1))
    cols = (ids, ths, gram[own[first]].view(np.int64), extent.view(np.int64), lo.astype(np.int32), hi.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=SEEDS)


def seed_rows(texts: DataFrame, width: int, k: int) -> DataFrame:
    def run(it):
        docs = (r for batch in it for r in rows_of(batch, "__id", "__th", "__text"))
        for parts, hashes in pieces(docs, width):
            yield seeds_of(parts, hashes, width, k)

    return texts.select("__id", "__th", "__text").mapInArrow(run, DDL["SEEDS"])


def hot_seeds(texts: DataFrame, width: int, k: int) -> DataFrame:
    """(seed, salts) of seeds that are met often on a share of the documents; at most MOST_HOT."""
    part = seed_rows(texts.filter(F.pmod(F.xxhash64("__id"), F.lit(SHARE)) == 0), width, k)
    counts = materialize(part.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "seed-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(LEAST_HOT // SHARE, -(-total // MOST_HOT))      # so at most MOST_HOT seeds reach it
    return counts.filter(F.col("n") >= least).select("seed", F.ceil(F.col("n") / least + 1).cast("int").alias("salts"))


def salted(rows: DataFrame) -> Column:
    return F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")


def join_seeds(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Occurrences settled by an equal extent (``whole``), and one per extent to be extended."""
    marked = rows.join(F.broadcast(hot), "seed", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    marked = marked.withColumn("salt", salted(marked))
    names = ("seed", "salt", "extent", "id", "th", "lo", "hi", "salts")
    ordered = marked.select(*names).repartition("seed", "salt").sortWithinPartitions("seed", "salt", "extent")

    def run(it):
        def found():
            every = (r for batch in it for r in rows_of(batch, *names, step=4096))
            for (seed, _), occurrences in groupby(every, itemgetter(0, 1)):
                waiting, extents = None, 0
                for _, same in groupby(occurrences, itemgetter(2)):
                    _, _, _, i, th, lo, hi, salts = next(same)
                    follow, settled = (i, th, seed, salts, lo, hi, False), False
                    for _, _, _, j, tj, a, b, _ in same:
                        if not settled:
                            yield i, th, seed, salts, lo, hi, True
                            settled = True
                        yield j, tj, seed, salts, a, b, True
                    extents += 1
                    if salts > 1 or extents > 2:
                        yield follow
                    elif extents == 2:
                        yield waiting
                        yield follow
                    else:
                        waiting = follow

        yield from batches(found(), FOUND, lambda r: 64)

    return ordered.mapInArrow(run, DDL["FOUND"])


def window_rows(texts: DataFrame, follow: DataFrame, width: int) -> DataFrame:
    """The windows of the occurrences to be extended, one row each."""
    spot = F.struct("seed", "salts", "lo", "hi")
    spots = follow.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_list(spot).alias("__spots"))

    def run(it):
        for batch in it:
            for i, th, text, held in rows_of(batch, "__id", "__th", "__text", "__spots", step=16):
                hashes = hash_words(words_of(text))
                lo, hi = np.array([s["lo"] for s in held]), np.array([s["hi"] for s in held])
                n = hi - lo + 1
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                win = grams(hashes, width)[at].view(np.int64)
                seed, salts = np.repeat([s["seed"] for s in held], n), np.repeat([s["salts"] for s in held], n)
                cols = (np.full(len(at), i), np.full(len(at), th), seed, salts.astype(np.int32), win, at.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=WINDOWS)

    # every column goes in: the exchange of ``texts`` is then the one that the last join reuses
    return texts.join(spots, ["__id", "__th"]).mapInArrow(run, DDL["WINDOWS"])


def meet(ordered: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose key is met again, and of salted keys one row for a second look (``again``)."""
    names = (*keys, "id", "th", "seed", "win", "at", "salts")
    width = len(keys)

    def run(it):
        def found():
            every = (r for batch in it for r in rows_of(batch, *names, step=4096))
            for _, same in groupby(every, itemgetter(*range(width))):
                row = next(same)
                once = row[width:-1]
                if row[-1] > 1:
                    yield *once, True
                settled = False
                for other in same:
                    if not settled:
                        yield *once, False
                        settled = True
                    yield *other[width:-1], False

        yield from batches(found(), MET, lambda r: 64)

    return ordered.mapInArrow(run, DDL["MET"])


def repeated_windows(windows: DataFrame, any_hot: bool) -> DataFrame:
    """(id, th, at) of the windows that occur elsewhere."""
    rows = windows.withColumn("salt", salted(windows))
    keys = ("seed", "win", "salt")
    first = meet(rows.repartition(*keys).sortWithinPartitions(*keys), keys)
    found = first.filter("NOT again")
    if any_hot:    # at most one row per salt is left of a salted window
        left = first.filter("again").withColumn("salts", F.lit(1))
        found = found.unionByName(meet(left.repartition("seed", "win").sortWithinPartitions("seed", "win"), ("seed", "win")).filter("NOT again"))
    return found.select("id", "th", "at")


def cut(text: str | None, ranges: list[int] | None) -> tuple[int, int, bytes, list[int]]:
    """Words, removed words, kept words joined by a space, and the maximal removed ranges."""
    words = words_of(text)
    if not ranges:
        return len(words), 0, b" ".join(words), []
    both = np.sort(np.array(ranges, np.int64))
    start, stop = both >> 32, np.maximum.accumulate(both & 0xFFFFFFFF)
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    start, stop = start[new], stop[np.concatenate([new[1:], [True]])]
    edge = [0, *np.stack([start, stop], 1).ravel().tolist(), len(words)]
    kept = b" ".join(w for a, b in zip(edge[::2], edge[1::2]) for w in words[a:b])
    return len(words), int((stop - start).sum()), kept, edge[1:-1]


def dedup_substrings(docs: DataFrame, width: int = 35, k: int = 8, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, n_words, n_removed, kept (text of the words left,
    joined by a space) and removed (maximal ranges as start, stop, start, stop, ... in words).

    A word goes if it lies in a window of ``width`` words whose words also start anywhere else, in
    the same document or another; windows are judged on the input.  Null text has no words and
    is kept empty.  Repeated rows repeat each other.  Null ids are kept.  Columns of ``docs``
    other than these are not read; an empty table gives an empty result.  Kept columns must not be named
    like the added ones, nor __id, __th, __text, __ranges (``cut_repeats`` takes any names).
    """
    ship(docs.sparkSession)
    key = ("__id", "__th")
    none = F.lit(-(1 << 63)).cast("long")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), none).alias("__id"), F.xxhash64("text").alias("__th"), F.col("text").alias("__text"), *(n for n in keep if n != "text"))
    hot = materialize(hot_seeds(texts, width, k), "hot-seeds")
    found = materialize(join_seeds(seed_rows(texts, width, k), hot), "seeds")
    dealt = texts.repartition(*key)
    ends = repeated_windows(window_rows(dealt, found.filter("NOT whole"), width), hot.head(1) != [])
    span = lambda a, b: F.shiftleft(a.cast("long"), 32) + b
    own = (F.col("id").alias("__id"), F.col("th").alias("__th"))
    ranges = found.filter("whole").select(*own, span(F.col("lo"), F.col("hi") + width).alias("range")).unionByName(
        ends.select(*own, span(F.col("at"), F.col("at") + width).alias("range")))
    ranges = ranges.groupBy(*key).agg(F.collect_set("range").alias("__ranges"))
    src = dealt.join(ranges, list(key), "left").select(*(F.col("__text").alias(n) if n == "text" else F.col(n) for n in keep), "__text", "__ranges")
    schema = src.select(*keep).withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit(""), "removed": F.array().cast("array<int>")}).schema
    names = list(keep)

    def run(it):
        for batch in it:
            fields = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept", pa.string()), pa.field("removed", pa.list_(pa.int32()))]

            def rows():
                for text, held in rows_of(batch, "__text", "__ranges", step=64):
                    n, gone, kept, removed = cut(text, held)
                    yield n, gone, kept.decode(), removed

            yield from beside(batch, names, fields, rows(), lambda r: len(r[-2]) + 4 * len(r[-1]))

    return src.mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def cut_repeats(docs: DataFrame, width: int = 35, k: int = 8) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text`` (n_chars follows, where present).
    A text without such a passage stays as it is."""
    inner, names = shielded(docs)
    done = dedup_substrings(inner, width, k, keep=tuple(names))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    changed = lambda n, c: F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col(n)) if c in new else F.col(n)
    return done.select(*(changed(n, c).alias(c) for n, c in zip(names, docs.columns)))
