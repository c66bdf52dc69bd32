"""Whitening of embeddings, with covariances found by polarisation in whole numbers.

Entries become integers (``floor(scale * c) + offset``).  Two passes gather exact sums:

1. vectors and sums per dimension, from which every dimension gets a whole-number centre;
2. the squares of the centred values, of every dimension and of the sum of every two dimensions.

From ``var(a + b) = var(a) + var(b) + 2 cov(a, b)`` all cross-covariances are differences of such
variances; the remainder that the whole-number centre leaves is taken off exactly.  So the covariance
matrix doesn't depend on the partitions, nor on the order of rows, and is rounded once, for ``eigh`` on
the driver.  A third pass measures the covariance of the whitened values; the last one returns them.

What leaves a task is a row per number and 32-bit limb, at most d(d+1)/2 numbers for d dimensions, summed by Spark.
Vectors of another length are a fit list of their own.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, ship

SCALE, OFFSET, TOP = 64, 1_000_000, 32
LARGEST = 2 ** 60        # integers beyond it, from entries over about 10^16, count as it
CELLS = 1 << 25          # numbers of all covariance matrices that the driver takes
STEP = 4096              # rows handled at once
SAFE = 2 ** 62
_LIMB = (1 << 32) - 1


def whole(vectors: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vectors, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vectors.isNotNull() & finite, F.lit(False))


def integers(c: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """x of the entries; exact, as scaling by a power of two and flooring are."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(c.astype(np.float64) * scale), -LARGEST, LARGEST).astype(np.int64) + offset


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of entries) per vector length, in pieces of up to ``STEP`` rows."""
    ends = column.offsets.to_numpy()
    sizes, values = np.diff(ends), column.values.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        for i in range(0, len(at), max(1, min(STEP, (1 << 22) // int(d)))):
            part = at[i:i + max(1, min(STEP, (1 << 22) // int(d)))]
            yield part, values[ends[part][:, None] + np.arange(d)]


def wide(m: np.ndarray, bound: int) -> np.ndarray:
    """``m`` as it is if results up to ``bound`` fit 64 bits, else in Python's integers."""
    return m if bound < SAFE else m.astype(object)


def largest(m: np.ndarray) -> int:
    return int(max(m.max(), -m.min())) if m.size else 0


def added(a: np.ndarray, b: np.ndarray | None) -> np.ndarray:
    """Their sum, in Python's integers if 64 bits might not hold it."""
    if b is None:
        return a
    return a + b if largest(a) + largest(b) < SAFE else a.astype(object) + b


def pair_squares(z: np.ndarray) -> np.ndarray:
    """Sums over the rows of (z_i + z_j)^2 for i < j, and of z_i^2 at (i, i); other places hold zero."""
    d = z.shape[1]
    z = wide(z, 4 * largest(z) ** 2 * len(z))
    out = np.zeros((d, d), z.dtype)
    for i in range(d):
        s = z[:, i:] + z[:, i:i + 1]
        s[:, 0] = z[:, i]
        out[i, i:] = (s * s).sum(axis=0)
    return out


def limbs(key: int, numbers) -> Iterator[tuple[int, int, int, int]]:
    """(key, place, limb, value) rows that add up to the integers, with signed values."""
    for place, v in enumerate(map(int, numbers)):
        sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
        while v:
            if v & _LIMB:
                yield key, place, limb, sign * (v & _LIMB)
            v, limb = v >> 32, limb + 1


def exact_sums(vectors: DataFrame, gather) -> dict[int, dict[int, int]]:
    """{length: {place: sum}} of what ``gather(held, matrix)`` adds up in the dict of a task."""
    ship(vectors.sparkSession)
    kinds = "d int, place int, limb int, value long"
    cols = pa.schema([("d", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in it:
            for _, m in matrices(batch.column(0)):
                gather(held, m)
        for d, sums in held.items():
            rows = list(limbs(d, sums))
            for i in range(0, len(rows), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + (1 << 16)]), cols.types)], schema=cols)

    out: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    parts = vectors.mapInArrow(run, kinds).groupBy("d", "place", "limb").agg(F.sum("value").alias("value"))
    for d, place, limb, value in parts.collect():
        out[d][place] += int(value) << 32 * limb
    return out


@dataclass
class Fit:
    """What whitening of vectors of one length takes."""

    n: int
    centre: list[int]            # whole-number centre per dimension
    rest: list[int]              # S - n * centre, from 0 to n - 1
    weights: np.ndarray          # d x components, NaN where a component has no variance
    explained: list[float | None]
    identity_error: float | None = None

    def whitened(self, z: np.ndarray) -> np.ndarray:
        return (z - np.array([r / self.n for r in self.rest])) @ self.weights

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2 per row; None where it doesn't fit a long."""
        r, n, d = max(self.rest), self.n, z.shape[1]
        z = wide(z, d * (n * (largest(z) + 1) + r) ** 2)
        y = z * n - np.array(self.rest, z.dtype)
        return [v if v < 2 ** 63 else None for v in map(int, (y * y).sum(axis=1))]


def centred(m: np.ndarray, centre: list[int], scale: int, offset: int) -> np.ndarray:
    return integers(m, scale, offset) - np.array(centre, np.int64)


def assembled(n: int, rest: list[int], squares: dict[int, int]) -> np.ndarray:
    """Covariance matrix from the sums of squares of centred values and of their pair sums."""
    d = len(rest)
    exact = lambda i, j: n * squares.get(i * d + j, 0) - (rest[i] + rest[j] if j > i else rest[i]) ** 2  # noqa: E731  n^2 variance
    var = [exact(i, i) for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = var[i] / n ** 2
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (exact(i, j) - var[i] - var[j]) / (2 * n ** 2)
    return v


def fit(rows: DataFrame, column: str = "embedding", top: int = TOP, scale: int = SCALE, offset: int = OFFSET) -> dict[int, Fit]:
    """A ``Fit`` per vector length.  Vectors that are null, empty or hold null or non-finite entries take no part."""
    good = rows.select(F.col(column).alias("v")).filter(whole(F.col("v")) & (F.size("v") > 0))

    def sums(held, m):
        d, x = m.shape[1], integers(m, scale, offset)
        s = wide(x, largest(x) * len(x)).sum(axis=0)
        old = held.get(d, [0] * (d + 1))
        held[d] = [a + int(b) for a, b in zip(old, [len(x), *s])]

    first = exact_sums(good, sums)
    if sum(d * d for d in first) > CELLS:
        raise ValueError("covariance matrices too large for the driver")
    centres = {d: [p.get(i + 1, 0) // p[0] for i in range(d)] for d, p in first.items()}

    def squares(held, m):
        d = m.shape[1]
        s = pair_squares(centred(m, centres[d], scale, offset))
        held[d] = added(s.reshape(-1), held.get(d))

    second, fits = exact_sums(good, squares) if first else {}, {}
    for d, p in first.items():
        n, centre = p[0], centres[d]
        rest = [p.get(i + 1, 0) - n * c for i, c in enumerate(centre)]
        v = assembled(n, rest, second.get(d, {}))
        size = np.abs(v).max() or 1.0
        e, u = np.linalg.eigh(v / size)
        e, u = e[::-1][:top] * size, u[:, ::-1][:, :top]
        there = e > d * np.finfo(float).eps * max(e[0], 0.0)
        weights = np.where(there, u / np.sqrt(np.where(there, e, 1.0)), np.nan)
        trace = float(np.trace(v))
        fits[d] = Fit(n, centre, rest, weights, [float(x) / trace if trace > 0 else None for x in np.maximum(e, 0.0)])
    for d, worst in identity_errors(good, fits, scale, offset).items():
        fits[d].identity_error = worst
    return fits


def identity_errors(vectors: DataFrame, fits: dict[int, Fit], scale: int, offset: int) -> dict[int, float]:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, per length, measured on all vectors;
    components without variance are left out."""
    if not fits:
        return {}
    ship(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)
    cols = pa.schema([("d", pa.int32()), ("place", pa.int32()), ("value", pa.float64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in it:
            for _, m in matrices(batch.column(0)):
                d, f = m.shape[1], shared.value[m.shape[1]]
                w = f.whitened(centred(m, f.centre, scale, offset))
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                held[d] = held.get(d, 0) + w.T @ w
        for d, s in held.items():
            s = s.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), d, np.int32)), pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], schema=cols)

    sums = {d: np.zeros((f.weights.shape[1] + 1,) * 2) for d, f in fits.items()}
    for d, place, value in vectors.mapInArrow(run, "d int, place int, value double").groupBy("d", "place").agg(F.sum("value")).collect():
        sums[d].reshape(-1)[place] = value
    out = {}
    for d, s in sums.items():
        mean, there = s[-1, :-1] / fits[d].n, ~np.isnan(fits[d].weights[0])
        off = np.abs(s[:-1, :-1] / fits[d].n - np.outer(mean, mean) - np.eye(len(mean)))[np.ix_(there, there)]
        if off.size:
            out[d] = float(off.max())
    return out


def whiten(rows: DataFrame, fits: dict[int, Fit], column: str = "embedding", keep: tuple[str, ...] = ("vec_id",),
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """The columns ``keep`` and n, deviation, whitened (an array, a value per component), explained (likewise) and
    identity_error of every vector that took part in the fit of its length."""
    spark = rows.sparkSession
    ship(spark)
    clash = set(keep) & {"n", "deviation", "whitened", "explained", "identity_error"}
    if clash:
        raise ValueError(f"columns to keep are named like added ones: {sorted(clash)}")
    (v,) = fresh(keep, "vector")
    src = rows.select(*keep, F.col(column).alias(v)).filter(whole(F.col(v)) & F.size(v).isin(list(fits)))
    shared, own = spark.sparkContext.broadcast(fits), list(keep)
    schema = rows.select(*keep, F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"),
                         F.lit(None).cast("array<double>").alias("explained"), F.lit(None).cast("double").alias("identity_error")).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = pa.schema([*(batch.schema.field(c) for c in own), pa.field("n", pa.int64()), pa.field("deviation", pa.int64()),
                              pa.field("whitened", pa.list_(pa.float64())), pa.field("explained", pa.list_(pa.float64())), pa.field("identity_error", pa.float64())])
            for at, m in matrices(batch.column(v)):
                f, n = shared.value[m.shape[1]], len(at)
                z = centred(m, f.centre, scale, offset)
                w, k = f.whitened(z), f.weights.shape[1]
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                flat = pa.array(w.reshape(-1), from_pandas=True)                  # NaN, a component without variance, is null
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(at)) for c in own), pa.array(np.full(n, f.n, np.int64)), pa.array(f.deviations(z), pa.int64()),
                    pa.ListArray.from_arrays(ends, flat), pa.array([f.explained] * n, pa.list_(pa.float64())),
                    pa.array([f.identity_error] * n, pa.float64())], schema=cols)

    return src.mapInArrow(run, schema) if fits else spark.createDataFrame([], schema)


def components(rows: DataFrame, top: int = TOP, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",), scale: int = SCALE,
               offset: int = OFFSET) -> DataFrame:
    """A row per vector and component up to ``top`` (all, if the vector has fewer): ``keep``, component, n, deviation, whitened,
    explained, identity_error.

    Null vectors and those with null or non-finite entries are dropped, empty ones have no component.  Vectors of each
    length are fitted apart.  Repeated rows all count and all come back.  A component without variance (all of a table of equal
    vectors; those beyond the rank of few vectors) has null whitened values and is no part of identity_error; ``explained``
    is null if nothing varies.  A deviation that doesn't fit a long is null.  Other columns of ``rows`` are not read.
    """
    done = whiten(rows, fit(rows, column, top, scale, offset), column, keep, scale, offset)
    (pair,) = fresh(done.columns, "pair")
    return done.select(*keep, "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", pair)).select(
        *keep, (F.col("component") + 1).alias("component"), "n", "deviation", F.col(pair)["whitened"].alias("whitened"),
        F.col(pair)["explained"].alias("explained"), "identity_error")
