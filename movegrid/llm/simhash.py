"""SimHash near-duplicates by pigeonhole blocks.

The 64 bits are cut into ``m`` blocks.  Two fingerprints that differ in at most ``d`` bits agree
on at least ``m - d`` whole blocks, so they share one of the C(m, d) keys that each keep ``m - d``
blocks.  Distinct fingerprints (copies are collapsed first) are joined on these keys and every
pair under a key is verified by Hamming distance.  ``m`` is the least for which an unrelated
fingerprint is rarely met under a key; any ``m`` finds exactly the same links.

A bucket hands on a spanning forest of its verified links, not its pairs.  A bucket with more
than ``FULL`` fingerprints (many near copies) is not gathered: its fingerprints are keyed again
with ``FINE`` blocks, where all fingerprints of a key differ in the freed blocks only, which
bounds every bucket by 2**12 without dropping a link.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches, fresh, materialize, quoted, rows_of, ship
from .components import components

SEED = 42
FULL = 4096          # distinct fingerprints a bucket may gather
FINE = 16            # blocks of four bits: with d = 3, twelve bits stay free
CHUNK = 1 << 15      # shingles counted at once
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 if it has no words.

    A-Z are lower-cased, words are runs without ASCII white space, repeats count, and a text of
    fewer words than ``shingle`` is one shingle.  A bit is set if it is in over half the hashes.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    width = min(shingle, len(words))
    total, counts = len(words) - width + 1, np.zeros(64, np.int64)
    for i in range(0, total, CHUNK):
        part = words[i:i + CHUNK + width - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(width))))
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp``, one row per input row; one narrow stage, whole texts."""
    ship(docs.sparkSession)
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = src.select(*keep).withColumn("fp", F.lit(0).cast("long")).schema
    names = list(keep)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = pa.schema([*(batch.schema.field(n) for n in names), pa.field("fp", pa.int64())])
            yield from batches(((*r[:-1], fingerprint(r[-1], shingle)) for r in rows_of(batch, *names, "__text")), cols, lambda r: 64)

    return src.mapInArrow(run, schema)


def block_masks(m: int, d: int) -> list[int]:
    """Masks that keep ``m - d`` of ``m`` blocks, as signed 64-bit numbers."""
    cut = [64 * i // m for i in range(m + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:])]
    masks = (sum(block[i] for i in keep) for keep in combinations(range(m), m - d))
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def blocks_for(n: int, d: int) -> int:
    """The least number of blocks whose kept bits outnumber the fingerprints sixteenfold."""
    return next((m for m in range(d + 1, FINE) if 2 ** (64 * (m - d) // m) >= 16 * n), FINE)


def keyed(fps: DataFrame, m: int, d: int) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(x)).alias("key")) for i, x in enumerate(block_masks(m, d))))
    return fps.select("fp", F.inline(keys))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(values: np.ndarray, d: int) -> list[tuple[int, int]]:
    """(least of its component, member) for the components of a bucket's verified links."""
    found, left = [], np.sort(values)
    while len(left) > 1:
        root, inside, queue = left[0], np.zeros(len(left), bool), [0]
        inside[0] = True
        while queue:
            near = (distance(left[queue.pop()], left) <= d) & ~inside
            inside |= near
            queue.extend(np.flatnonzero(near).tolist())
        found += [(int(root), x) for x in left[inside].tolist() if x != root]
        left = left[~inside]
    return found


def bucket_edges(pairs: DataFrame, d: int) -> DataFrame:
    """Spanning links (a, b) of every bucket (part, key); buckets are bounded by the caller."""
    ordered = pairs.repartition("part", "key").sortWithinPartitions("part", "key")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges():
            part, key, fp = (np.empty(0, np.int64) for _ in range(3))
            for batch in it:
                part, key, fp = (np.concatenate([old, batch.column(n).to_numpy().astype(np.int64)]) for old, n in ((part, "part"), (key, "key"), (fp, "fp")))
                cut = np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0)) + 1
                last = cut[-1] if len(cut) else 0      # the last bucket may go on in the next batch
                yield from runs(fp[:last], cut[:-1])
                part, key, fp = part[last:], key[last:], fp[last:]
            yield from runs(fp, np.empty(0, np.int64))

        def runs(fp, cut):
            first = np.concatenate([[0], cut])
            size = np.diff(np.concatenate([first, [len(fp)]]))
            two = first[size == 2]
            near = two[distance(fp[two], fp[two + 1]) <= d]
            yield from zip(fp[near].tolist(), fp[near + 1].tolist())
            for i, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                yield from forest(fp[i:i + n], d)

        yield from batches(edges(), EDGES, lambda r: 16)

    return ordered.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, n: int, d: int = 3) -> DataFrame:
    """Links that connect all distinct fingerprints ``fps`` (fp) at ``d`` bits or fewer."""
    wide = keyed(fps, blocks_for(n, d), d)
    sizes = wide.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = wide.join(sizes, ["part", "key"])
    light = bucket_edges(met.filter(F.col("n") <= FULL), d)
    heavy = met.filter(F.col("n") > FULL).select("fp").distinct()
    return light.unionByName(bucket_edges(keyed(heavy, FINE, d), d))


def fp_components(prints: DataFrame, d: int = 3) -> DataFrame:
    """(fp, root) for each distinct ``fp`` of ``prints``: the smallest fingerprint reachable."""
    fps = materialize(prints.select("fp").distinct(), "fps")
    roots = components(links(fps, fps.count(), d))
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def simhash_components(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id.

    Null or wordless texts have fingerprint zero and link like any other.  Copies share their
    fingerprint and hence their component.  component_id is the smallest doc_id reachable; null
    ids take part, but a component's id is null only if all its ids are.  An empty table gives
    an empty result; other columns are not read.
    """
    prints = materialize(fingerprints(docs, shingle), "prints")
    roots = materialize(fp_components(prints, bits), "roots")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(roots, "fp").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = roots.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (nulls last, ties by text hash)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("hash"))
    (own,) = fresh(docs.columns, "key")
    marked = docs.withColumn(own, key)
    prints = materialize(fingerprints(marked.select(F.col(own).alias("key"), "text"), shingle, keep=("key",)), "prints")
    roots = fp_components(prints, bits)
    first = prints.groupBy("fp").agg(F.min("key").alias("key")).join(roots, "fp").groupBy("root").agg(F.min("key").alias(own))
    kept = marked.join(first.select(own), own, "left_semi")
    if prints.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").head(1):
        kept = kept.dropDuplicates([own])     # whole rows are repeated
    return kept.select(*map(quoted, docs.columns))
