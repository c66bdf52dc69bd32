"""Language identification by nearest centroids of character n-grams.

A text is folded to lower-case letters and single spaces; its n-grams of 1 to 4 code points are
counted in hashed places, weighted (``log(1 + count)`` times the inverse document frequency) and
normalised.  The document frequencies come from all learning rows.  Per language, spherical
k-means over a bounded sample (``SAMPLE`` rows a language) gives several centroids; a text has the
language of the centroid with the largest cosine.  It is rejected if that cosine is lower than what sample
texts with as few letters had, by more than ``SLACK`` of it.

Counting and predicting are narrow stages over whole texts, read in pieces; each language is clustered
by one task from its bounded sample, and only centroids reach the driver.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import batches, fresh, materialize, rows_of, ship

PLACES = 1 << 14
LENGTHS = (1, 2, 3, 4)
SAMPLE = 256           # rows a language that centroids are made from
CENTROIDS = 4          # a language
LANGUAGES = 2048       # the largest label set; a model holds PLACES numbers per centroid
ROUNDS = 12
PIECE = 1 << 18        # code points handled at once
BANDS = tuple(4 ** b for b in range(1, 8))     # letters from which a text is of the next band
SLACK = 0.25           # part of the lowest cosines of a band by which a text may be farther
LOWEST = 0.01          # share of the sample that has these lowest cosines
UNKNOWN = "und"
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
_SHIFT = np.uint64(64 - (PLACES.bit_length() - 1))


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """The lower-case letter of every code point, a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def folded(text: str) -> Iterator[np.ndarray]:
    """Letters and single spaces of a text, with a space before and after, in pieces."""
    fold, last = folding(), 32
    yield np.array([32], np.uint32)
    for i in range(0, len(text), PIECE):
        codes = fold[np.frombuffer(text[i:i + PIECE].encode("utf-32-le"), np.uint32)]
        before = np.concatenate([[last], codes[:-1]])
        codes = codes[(codes != 32) | (before != 32)]
        if len(codes):
            last = int(codes[-1])
            yield codes
    if last != 32:
        yield np.array([32], np.uint32)


def counts(text: str | None) -> tuple[np.ndarray, int]:
    """N-gram counts by place, and the number of letters."""
    out, letters, tail = np.zeros(PLACES, np.int64), 0, np.zeros(0, np.uint64)
    for piece in folded(text or ""):
        letters += int(np.count_nonzero(piece != 32))
        codes = np.concatenate([tail, piece.astype(np.uint64) + np.uint64(1)])
        new, acc = len(tail), None
        for n in range(1, max(LENGTHS) + 1):
            acc = codes * _MIX if acc is None else (acc[:-1] ^ codes[n - 1:]) * _STEP * _MIX
            if n in LENGTHS:
                out += np.bincount(((acc[max(0, new - n + 1):] + np.uint64(n)) * _MIX >> _SHIFT).astype(np.int64), minlength=PLACES)
        tail = codes[-(max(LENGTHS) - 1):]
    return out, letters


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The unit vector of n-gram counts (zero, where there are none)."""
    v = np.zeros(len(count), np.float32)
    at = np.flatnonzero(count)
    v[at] = np.log1p(count[at]) * idf[at]
    return v / (np.linalg.norm(v) or 1.0)


def band(letters: int) -> int:
    return sum(letters >= b for b in BANDS)


def clustered(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of spherical k-means; starts are the farthest points, so the result is fixed."""
    at = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[at[0]]
    while len(at) < min(k, len(x)) and near.min() < 1 - 1e-6:
        at.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[at[-1]])
    c = x[at]
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray            # per place
    centroids: np.ndarray      # PLACES x all centroids
    owner: np.ndarray          # language number per centroid
    lowest: np.ndarray         # language x band: cosines below it are rejected

    def nearest(self, vectors: np.ndarray, letters: list[int]) -> Iterator[tuple[str | None, float, bool]]:
        """(language, cosine from 0 to 1, rejected) per vector; None where there is no letter."""
        cosines = vectors @ self.centroids
        for row, n in zip(cosines, letters):
            i = int(np.argmax(row))
            score = min(1.0, max(0.0, float(row[i])))
            lang = int(self.owner[i])
            yield (self.languages[lang], score, score < self.lowest[lang, band(n)]) if n else (None, 0.0, True)


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and, per place, of rows whose ``text`` has an n-gram there."""
    ship(docs.sparkSession)
    cols = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(PLACES, np.int64), 0
        for batch in it:
            for (text,) in rows_of(batch, "text", step=32):
                held += counts(text)[0] > 0
                seen += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(held[at], seen))], schema=cols)

    out, total = np.zeros(PLACES, np.int64), 0
    for place, n in docs.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n")).collect():
        if place < 0:
            total = n
        else:
            out[place] = n
    return total, out


def sampled(docs: DataFrame, sample: int, of: dict[str, int]) -> DataFrame:
    """``lang`` and ``text`` of at most ``sample`` ids per language, first by a hash of the id; of an id's
    texts in one language the smallest.  ``of``: ids per language, about, by which they are thinned first."""
    every = F.create_map(*(F.lit(x) for lang, n in of.items() for x in (lang, max(1, n // (4 * sample)))))
    ids = docs.select("lang", "doc_id").filter(F.pmod(F.xxhash64("doc_id"), every[F.col("lang")]) == 0).distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("order"), "doc_id"), "doc_id")
    drawn = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample).drop("place")
    return docs.join(F.broadcast(drawn), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model | None:
    """The model of rows (doc_id, text, lang); rows without lang, id or a letter teach nothing.  None without rows.

    ``sample`` bounds the rows a language is clustered from; everything else is counted on all rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(of) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not of:
        return None
    total, df = frequencies(rows)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    spans = (*BANDS, None)
    cols = pa.schema([("lang", pa.string()), ("span", pa.int32()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    shared = spark.sparkContext.broadcast(idf)

    def spelled(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sparse counts of every whole text, and of its beginnings of each band's length."""
        def made():
            for batch in it:
                for lang, text in rows_of(batch, "lang", "text", step=32):
                    for span in spans:
                        if span is None or span < len(text):
                            c, letters = counts(text if span is None else text[:2 * span])
                            at = np.flatnonzero(c)
                            if letters:
                                yield lang, -1 - band(letters) if span is None else band(letters), at.tolist(), c[at].tolist()
        return batches(made(), cols, lambda r: 16 * len(r[2]))

    def cluster(table: pa.Table) -> pa.Table:
        """One language: its centroids (number from 0) and lowest cosines (numbered from -1 by band)."""
        idf, lang = shared.value, table.column("lang")[0].as_py()
        spans, places, held = (table.column(n).to_pylist() for n in ("span", "places", "counts"))
        order = sorted(range(len(spans)), key=lambda i: (spans[i], places[i], held[i]))

        def vector(i):
            c = np.zeros(PLACES, np.int64)
            c[places[i]] = held[i]
            return weighted(c, idf)

        whole = [i for i in order if spans[i] < 0]
        c = clustered(np.stack([vector(i) for i in whole]), centroids)
        near: dict[int, list[float]] = {}
        for i in order:
            near.setdefault(-1 - spans[i] if spans[i] < 0 else spans[i], []).append(float((c @ vector(i)).max()))
        low, last = np.zeros(len(BANDS) + 1, np.float32), 0.0
        for b in range(len(BANDS) + 1):
            last = low[b] = (1 - SLACK) * np.quantile(near[b], LOWEST) if b in near else last
        out = [(lang, j, v.tolist()) for j, v in enumerate(c)] + [(lang, -1, low.tolist())]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int32(), pa.list_(pa.float32())))], ["lang", "number", "v"])

    vectors = sampled(rows, sample, of).select("lang", "text").mapInArrow(spelled, "lang string, span int, places array<int>, counts array<long>")
    made = materialize(vectors.groupBy("lang").applyInArrow(cluster, "lang string, number int, v array<float>"), "languages").collect()
    made.sort(key=lambda r: (r["lang"], r["number"]))
    languages = sorted({r["lang"] for r in made})
    if not languages:
        return None
    parts = [r for r in made if r["number"] >= 0]
    return Model(languages, idf, np.array([r["v"] for r in parts], np.float32).T.copy(), np.array([languages.index(r["lang"]) for r in parts]),
                 np.array([r["v"] for r in made if r["number"] < 0], np.float32))


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred (the nearest language), score (its cosine, 0 to 1) and rejected (too far from
    every centroid to be of a learned language) for every row of ``docs`` (text).

    A null text, one without a letter and, without a model, any text is ``und`` with score 0, rejected.  Ties go to the
    language that sorts first.  Repeated rows all stay; other columns are not read; a kept column named like an added one
    raises ValueError.
    """
    clash = set(keep) & {"lang_pred", "score", "rejected"}
    if clash:
        raise ValueError(f"columns to keep are named like added ones: {sorted(clash)}")
    spark, own = docs.sparkSession, list(keep)
    ship(spark)
    (name,) = fresh(keep, "text")
    shared = spark.sparkContext.broadcast(model)
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected")).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def made(batch):
            for i in range(0, batch.num_rows, 64):
                rows = list(rows_of(batch.slice(i, 64), *own, name))
                if model is None:
                    said = [(None, 0.0, True)] * len(rows)
                else:
                    pairs = [counts(r[-1]) for r in rows]
                    said = model.nearest(np.stack([weighted(c, model.idf) for c, _ in pairs]), [n for _, n in pairs])
                for r, (lang, score, far) in zip(rows, said):
                    yield *r[:-1], lang or UNKNOWN, score, bool(far)

        for batch in it:
            cols = pa.schema([*(batch.schema.field(c) for c in own), pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())])
            yield from batches(made(batch), cols, lambda r: 64 + sum(len(v) for v in r if isinstance(v, str)))

    return docs.select(*keep, F.col("text").alias(name)).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text leaves 1 when divided by 3; not, for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """The contract's row per document, by a model learned from the rows that are not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
