"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a vector
of the unit sphere; its hash is the nearest signed axis.  Each table concatenates ``hashes`` of
them.  Vectors are indexed under their bucket of every table; a query probes, in every table,
the ``probes`` buckets whose axes lie closest to it.  Buckets hand on exact inner products of
the original vectors, the best ``top`` per query, and the best over all buckets are the result.

Buckets are dealt in chunks of about ``CHUNK`` vectors or ``CHUNK_BYTES`` (a hot bucket becomes many tasks' work,
and its queries visit each chunk), so a task holds one chunk and a stream of queries.  Ties are scored in
slices of ``TIED_BYTES``.  Vectors are scaled by powers of two before they are multiplied, which changes no digit, so
that products of large components don't overflow on the way.  Of equal
vectors only the ``top + 1`` smallest ids are indexed: no query can return another of them.
Equal queries are searched once.

A query whose probes reach fewer candidates than asked for, while its dimension holds more, is
searched exactly: blocks of such queries meet chunks of all vectors of their dimension.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import batches, materialize, rows_of, ship

SEED = 20240101
CHUNK = 16_384       # vectors of a chunk, if they are no more than
CHUNK_BYTES = 8 << 20
TIED_BYTES = 16 << 20
QUERIES = 64         # queries matched with a chunk at once
BLOCK = 2_048        # vectors of a chunk, and queries of a block, of the exact search
SLACK = 1e-9         # covers the rounding of the matrix product before scores are made anew
INDEX = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("bucket", pa.int64())])
HITS = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(unit: np.ndarray, table: int, nth: int) -> np.ndarray:
    """Scores of the signed axes (+1..+d, -1..-d) for one rotation of unit vectors."""
    d = 1 << max(0, unit.shape[1] - 1).bit_length()
    x = np.zeros((len(unit), d))
    x[:, :unit.shape[1]] = unit
    signs = np.random.default_rng([SEED, table, nth]).choice([-1.0, 1.0], size=(3, d))
    for s in signs:
        x = hadamard(x * s)
    return np.concatenate([x, -x], axis=1)


def best_buckets(unit: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` closest buckets of every row (fewer where there are fewer), closest first:
    those with the least sum of squared gaps to the best axis over the concatenated hashes."""
    code, cost = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for nth in range(hashes):
        scores = rotated(unit, table, nth)
        axes = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
        near = np.take_along_axis(scores, axes, 1)
        gap = (near[:, :1] - near) ** 2
        cost = (cost[:, :, None] + gap[:, None, :]).reshape(len(unit), -1)
        code = (code[:, :, None] * scores.shape[1] + axes[:, None, :]).reshape(len(unit), -1)
        least = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        cost, code = np.take_along_axis(cost, least, 1), np.take_along_axis(code, least, 1)
    return code


def usable(v: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def spread(rows: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(dim, part, bucket, id, vec) of every row (id, vec) for its closest buckets in each table."""
    ship(rows.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt():
            for batch in it:
                sizes = np.diff(batch.column("vec").offsets.to_numpy())
                for i in range(0, batch.num_rows, 1024):
                    part = batch.slice(i, 1024)
                    dims = sizes[i:i + 1024]
                    for dim in np.unique(dims):
                        some = part.filter(pa.array(dims == dim))
                        vec = np.array(some.column("vec").flatten(), np.float64).reshape(-1, dim)
                        ids, packed = some.column("id").to_pylist(), [v.tobytes() for v in vec]
                        unit = vec / np.abs(vec).max(1, keepdims=True)
                        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                        for table in range(tables):
                            for row, x, codes in zip(ids, packed, best_buckets(unit, table, hashes, probes).tolist()):
                                for c in codes:
                                    yield int(dim), table, c, row, x

        schema = pa.schema([*INDEX, pa.field("id", pa.int64()), pa.field("vec", pa.binary())])
        yield from batches(dealt(), schema, lambda r: len(r[-1]))

    return rows.mapInArrow(run, "dim int, part int, bucket long, id long, vec binary")


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with their largest component from 1/2 to 1, and the powers of two taken out."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -power[:, None]), power


def best_of(ids: np.ndarray, vecs: np.ndarray, queries: np.ndarray, top: int) -> Iterator[tuple[int, list[tuple[int, float]]]]:
    """Per query, the ``top`` vectors of a chunk by exact score, ties to smaller ids.

    The matrix product only preselects, with slack; scores are then summed vector by vector in
    one order, so that equal vectors score equally wherever they lie.
    """
    (queries, up), (vecs, high) = scaled(queries), scaled(vecs)
    power = up[:, None] + high[None, :]
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.ldexp(queries @ vecs.T, power)
        if len(ids) > top:
            least = np.partition(near, len(ids) - top, axis=1)[:, len(ids) - top, None]
            slack = np.ldexp(SLACK, power)
            keep = ~(near + slack < least - np.where(near >= least, slack, 0).max(axis=1, keepdims=True))     # not a number: kept
        else:
            keep = np.ones(near.shape, bool)
        step = max(1, TIED_BYTES // (8 * vecs.shape[1]))
        for q in range(len(queries)):
            of = np.flatnonzero(keep[q])
            score = np.concatenate([(queries[q] * vecs[of[i:i + step]]).sum(axis=1) for i in range(0, len(of), step)])
            score = np.ldexp(score, power[q, of])
            order = np.lexsort((ids[of], -score))[:top]
            yield q, list(zip(ids[of[order]].tolist(), score[order].tolist()))


def match(dealt: DataFrame, top: int) -> DataFrame:
    """(query, vec_id, score): the best of every chunk for every query that visits it."""
    key = ("dim", "part", "bucket", "salt")
    ordered = dealt.repartition(*key).sortWithinPartitions(*key, "kind", "id")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hits():
            every = (r for batch in it for r in rows_of(batch, *key, "kind", "id", "vec"))
            for _, rows in groupby(every, itemgetter(0, 1, 2, 3)):
                ids, packed, asked = [], [], []

                def answer():
                    queries = np.frombuffer(b"".join(x for _, x in asked)).reshape(len(asked), -1)
                    for q, found in best_of(held_ids, held, queries, top):
                        for i, score in found:
                            yield asked[q][0], i, score

                held = None
                for *_, kind, i, x in rows:
                    if kind == 0:
                        ids.append(i)
                        packed.append(x)
                        continue
                    if not ids:
                        break              # no vector in this bucket
                    if held is None:
                        held, held_ids = np.frombuffer(b"".join(packed)).reshape(len(ids), -1), np.array(ids)
                    asked.append((i, x))
                    if len(asked) == QUERIES:
                        yield from answer()
                        asked = []
                if asked:
                    yield from answer()

        yield from batches(hits(), HITS, lambda r: 24)

    return ordered.mapInArrow(run, "query long, vec_id long, score double")


def nearest_first() -> tuple[Column, Column]:
    return F.col("score").desc(), F.col("vec_id")


def best(hits: DataFrame, top: int) -> DataFrame:
    """The ``top`` of every query's (query, vec_id, score), each vec_id once."""
    once = hits.repartition("query").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy(*nearest_first()))
    return once.withColumn("nth", nth).filter(F.col("nth") <= top).drop("nth")


def unmet(rows: DataFrame, asked: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """(id, vec, dim) of the queries with fewer than ``top`` rows in ``kept`` although their
    dimension has more."""
    held = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("held"))
    met = kept.groupBy(F.col("query").alias("id")).agg(F.count(F.lit(1)).alias("met"))
    counted = asked.withColumn("dim", F.size("vec")).join(held, "dim").join(met, "id", "left")
    return counted.filter(F.coalesce("met", F.lit(0)) < F.least(F.lit(top), "held")).select("id", "vec", "dim")


def packed(rows: DataFrame) -> DataFrame:
    """(dim, id, vec) with the vectors as the bytes that ``match`` reads."""
    schema = pa.schema([("dim", pa.int32()), ("id", pa.int64()), ("vec", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (r for batch in it for r in rows_of(batch, "dim", "id", "vec"))
        yield from batches(((d, i, np.array(v, np.float64).tobytes()) for d, i, v in every), schema, lambda r: len(r[-1]))

    return rows.select("dim", "id", "vec").mapInArrow(run, "dim int, id long, vec binary")


def scan(rows: DataFrame, short: DataFrame) -> DataFrame:
    """Input of ``match`` in which every query of ``short`` visits every row of its dimension: a
    bucket per block of queries, a salt per chunk of rows."""
    dealt = lambda n, to: F.pmod(F.xxhash64("id"), F.col(n)).cast("int").alias(to)
    each = lambda n, to: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(to)
    parts = lambda df, n: df.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(n))
    of = rows.withColumn("dim", F.size("vec"))
    cuts = parts(short, "blocks").join(parts(of, "salts"), "dim")
    put = ("dim", F.lit(0).alias("part"), F.col("bucket").cast("long").alias("bucket"), "salt")
    held = packed(of.join(cuts.select("dim"), "dim")).join(cuts, "dim").select(
        "dim", "id", "vec", dealt("salts", "salt"), each("blocks", "bucket")).select(*put, F.lit(0).alias("kind"), "id", "vec")
    visits = packed(short).join(cuts, "dim").select(
        "dim", "id", "vec", dealt("blocks", "bucket"), each("salts", "salt")).select(*put, F.lit(1).alias("kind"), "id", "vec")
    return held.unionByName(visits)


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 20, tables: int = 10, hashes: int = 1, probes: int = 14) -> DataFrame:
    """The ``top`` rows of ``vectors`` with the largest inner product for every row of ``queries``.

    Both have vec_id and embedding (array of numbers; other columns are not read).  Returns
    query_id, rank (from 1), vec_id, score; nearest first, ties to smaller vec_id; a query's own
    vec_id is no candidate.  Vectors that are null, empty, zero, or hold null or non-finite
    components take no part, nor do rows without a vec_id; vectors of other lengths than the
    query's don't meet it.  Repeated rows count once.  Every query gets ``top`` rows, or all
    candidates where there are fewer.  Recall falls with more ``hashes`` and grows with ``tables``
    and ``probes``; scores are always exact.
    """
    def clean(df):
        vec = F.col("embedding").cast("array<double>")
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(usable(F.col("vec")) & F.col("vec_id").isNotNull())

    copies = Window.partitionBy("vec").orderBy("vec_id")
    rows = clean(vectors).distinct().withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= top + 1).select(F.col("vec_id").alias("id"), "vec")
    asked = clean(queries).distinct()
    once = asked.groupBy("vec").agg(F.min("vec_id").alias("id")).select("id", "vec")
    index = spread(rows, tables, hashes, 1)
    place = ["dim", "part", "bucket"]
    sizes = index.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / F.least(F.lit(CHUNK), F.greatest(F.lit(1), F.floor(F.lit(CHUNK_BYTES // 8) / F.max("dim"))))).cast("int").alias("salts"))
    held = index.join(sizes, place).select(*place, F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(0).alias("kind"), "id", "vec")
    visits = spread(once, tables, hashes, probes).join(sizes, place).select(
        *place, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(1).alias("kind"), "id", "vec")
    kept = materialize(best(match(held.unionByName(visits), top + 1), top + 1), "ann-found")
    short = materialize(unmet(rows, once, kept, top + 1), "ann-short")
    if not short.isEmpty():
        kept = kept.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(best(match(scan(rows, short), top + 1), top + 1))
    members = asked.join(once.withColumnRenamed("id", "query"), "vec").select(F.col("vec_id").alias("query_id"), "query")
    own = members.join(kept, "query").filter("query_id <> vec_id").select("query_id", "vec_id", "score")
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*nearest_first())))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
