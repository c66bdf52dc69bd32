"""Toxicity by a classifier chain of linear models.

Three categories are predicted one after the other:

* ``terms`` - the text uses terms that mark toxic texts,
* ``sustained`` - it uses them densely,
* ``toxic`` - it is labelled toxic.

Each is a logistic regression over the same features and the probabilities of the categories
before it.  While training, these probabilities are out-of-fold: they come from models that
have not seen the row, so later models learn from probabilities as honest as those they will get.
The terms (words, and beginnings of words) are found in the training rows, anew for every fold.

The data label one category, ``toxic``.  The first two are derived: their training labels are ``toxic`` and a test on
the text's marked terms, so what they add is how far a judgement rests on known terms, not knowledge of other labels.

The chain is trained on the driver on a bounded sample of labelled rows (``SAMPLE`` toxic and
twice as many others, texts up to ``SAMPLE_CHARS``) and broadcast; scoring is one narrow stage over
all rows and whole texts.
"""
from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import beside, fresh, rows_of, shielded, ship, thinned

SAMPLE = 2_000
SAMPLE_CHARS = 20_000
LEAST = 3            # toxic texts that a term must be in, where there are as many
TERMS = 240          # features taken from the training rows
STEMS = (4, 5, 6)    # lengths of the word beginnings that may be features
MARKED = 3.0         # log odds from which a term marks toxic texts
EVEN = 0.5           # least threshold
CLEAN = 0.02         # share of clean rows that may be judged toxic while training
FOLDS = 5
INNER = 3            # folds inside each training set
STEPS, RATE, SHRINK = 150, 0.1, 1e-3
CATEGORIES = ("terms", "sustained", "toxic")
_words = re.compile(r"\w+").findall


def names(word: str) -> list[str]:
    """Features a word may be: itself and its beginnings."""
    return [word, *(f"^{word[:n]}" for n in STEMS if len(word) >= n)]


class Corpus:
    """Training texts as counts of distinct words, from which terms and features of any of them follow quickly.

    Only names that are in enough toxic texts can become terms; they are told from the others by a table of hashed counts, so
    words without such a name are counted in lengths only and take no room."""

    def __init__(self, texts: list[str], toxic: np.ndarray):
        self.index: dict[str, int] = {}
        least = LEAST if (toxic > 0).sum() >= 4 * LEAST else 1          # a part of the rows may have to show as many
        met = np.zeros(1 << 22, np.uint8)
        for keep in (False, True):
            for text, bad in zip(texts, toxic):
                if bad:
                    for name in {x for word in set(_words(text.lower())) for x in names(word)}:
                        at = zlib.crc32(name.encode("utf-8", "surrogatepass")) & (len(met) - 1)
                        if not keep:
                            met[at] += met[at] < least
                        elif met[at] >= least:
                            self.index.setdefault(name, len(self.index))
        self.names = list(self.index)
        words: dict[str, int] = {}
        rows, ids, counts, of = array("i"), array("i"), array("i"), array("i")
        width = 1 + len(STEMS)
        self.lengths = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = Counter(_words(text.lower()))
            self.lengths[i] = sum(found.values())
            for word, n in found.items():
                k = words.get(word)
                if k is None:
                    own = [self.index.get(x, -1) for x in names(word)]
                    if max(own) < 0:
                        continue
                    k = words[word] = len(of) // width
                    of.extend(own + [-1] * (width - len(own)))
                rows.append(i)
                ids.append(k)
                counts.append(n)
        del words
        self.row, self.word, self.count = (np.array(x, np.int32) for x in (rows, ids, counts))
        self.of = np.array(of, np.int32).reshape(-1, width) if len(of) else np.full((1, width), -1, np.int32)     # names of each word
        self.pairs, size = [], max(1, len(self.names))       # (row, name) of each kind of name, once each
        for slot in self.of.T:
            name = slot[self.word]
            there = name >= 0
            pairs = self.row[there].astype(np.int64) * size
            pairs += name[there]
            del name, there
            pairs.sort()
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            self.pairs.append(((pairs // size).astype(np.int32), (pairs % size).astype(np.int32)))

    def pick_terms(self, toxic: np.ndarray, used: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        """The features that tell toxic texts best among the rows ``used``, and which of them mark toxic texts."""
        count = lambda rows: sum(np.bincount(name[rows[row]], minlength=len(self.names)) for row, name in self.pairs)
        n, clean = count(used & (toxic > 0)).astype(float), count(used & (toxic == 0))
        bad, good = max(1, int((toxic[used] > 0).sum())), max(1, int((toxic[used] == 0).sum()))
        odds = np.log((n + 0.5) / (bad + 1)) - np.log((clean + 0.5) / (good + 1))
        at = np.flatnonzero(n >= min(LEAST, bad))
        best = sorted(at.tolist(), key=lambda i: (-odds[i] * np.sqrt(n[i]), self.names[i]))[:TERMS]
        return {self.names[i]: k for k, i in enumerate(best)}, np.array([odds[i] >= MARKED for i in best], bool)

    def features(self, terms: dict[str, int], marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``Features`` gives for every text: a row each, and the share of marked words."""
        n, column = len(self.lengths), np.full(len(self.names) + 1, -1, np.int32)
        for name, k in terms.items():
            column[self.index[name]] = k
        cols = column[self.of]                                                  # the last place stands for no name
        counts = np.zeros(n * max(1, len(terms)))
        for slot in cols.T:
            c = slot[self.word]
            there = c >= 0
            counts += np.bincount(self.row[there].astype(np.int64) * max(1, len(terms)) + c[there], self.count[there], minlength=len(counts))
        marked = np.append(marks, False)[cols].any(axis=1)
        hits = np.bincount(self.row, self.count * marked[self.word], minlength=n)
        size = np.maximum(1, self.lengths)
        extra = np.stack([np.log1p(hits), np.log1p(100 * hits / size), hits >= 2, np.log1p(self.lengths) / 5], axis=1)
        x = np.concatenate([np.log1p(counts.reshape(n, -1)[:, :len(terms)]), extra], axis=1)
        return x.astype(np.float32), hits / size


class Features:
    """Feature vector of a text: counts of the terms, and how many words are marked terms."""

    def __init__(self, terms: dict[str, int], marks: np.ndarray):
        self.terms, self.marks = terms, marks
        self.starts = {n.lstrip("^")[:STEMS[0]] for n in terms}    # most words are passed over by these

    def marked(self, words: list[str]) -> tuple[np.ndarray, int]:
        counts, hits = np.zeros(len(self.terms), np.float32), 0
        near = [w for w in words if w[:STEMS[0]] in self.starts]
        for word in near:
            ids = [i for n in names(word) if (i := self.terms.get(n)) is not None]
            for i in ids:
                counts[i] += 1
            hits += any(self.marks[i] for i in ids)
        return counts, hits

    def vector(self, text: str | None) -> tuple[np.ndarray, float]:
        """The vector, and the share of marked words."""
        words = _words(text.lower()) if text else []
        counts, hits = self.marked(words)
        n = max(1, len(words))
        extra = [np.log1p(hits), np.log1p(100 * hits / n), hits >= 2, np.log1p(len(words)) / 5]
        return np.concatenate([np.log1p(counts), np.array(extra, np.float32)]), hits / n


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a logistic regression with a small penalty, by full-batch Adam."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    w, m, s = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    for step in range(1, STEPS + 1):
        g = x.T @ (sigmoid(x @ w) - y).astype(np.float32) / len(y) + SHRINK * w
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    terms: dict[str, int]
    marks: np.ndarray
    weights: list[np.ndarray]     # one per category, in order
    threshold: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A column per category; each model is fed the columns before its own."""
        for w in self.weights:
            x = np.concatenate([x, predict(x, w)[:, None].astype(np.float32)], axis=1)
        return x[:, -len(self.weights):]


def fold_of(key, folds: int = FOLDS) -> int:
    return zlib.crc32(repr(key).encode()) % folds


def folds_of(keys: list, y: np.ndarray, folds: int = FOLDS) -> tuple[np.ndarray, int]:
    """Every row's fold, and how many there are: ``folds`` by a hash of the key; with fewer rows of
    a kind as many as there are rows of it, each with its share of both kinds."""
    n = int(min(folds, y.sum(), len(y) - y.sum()))
    if n == folds and n > 1:
        return np.array([fold_of((folds, k) if folds != FOLDS else k, folds) for k in keys]), n
    return np.where(y > 0, np.cumsum(y > 0), np.cumsum(y == 0)) % n, n


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of out-of-fold probabilities with the best F1 of those that judge at most ``CLEAN`` of the clean rows toxic (one
    row at least)."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    wrong = np.arange(1, len(y) + 1) - right
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    f1[wrong > max(1, CLEAN * (len(y) - y.sum()))] = -1
    k = int(np.argmax(f1))
    low = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + low) / 2)


def targets(y: np.ndarray, share: np.ndarray, used: np.ndarray) -> list[np.ndarray]:
    """Labels of the three categories; what counts as dense follows from the rows ``used``."""
    own = y * (share > 0)
    dense = np.median(share[used & (own > 0)]) if (used & (own > 0)).any() else 0.0
    return [t.astype(np.float32) for t in (own, own * (share >= dense), y)]


def chain_of(corpus: Corpus, y: np.ndarray, used: np.ndarray, keys: list, inner: int = INNER) -> tuple[Chain, np.ndarray]:
    """The chain of the rows ``used`` and its probability of ``toxic`` for all rows.  No other row has a part in it.

    Inside, terms, marks and labels of the derived categories are found anew for every fold from the rows outside it; the models of a
    fold give its rows the probabilities that later categories are trained with."""
    at = np.flatnonzero(used)
    fold = np.full(len(y), -1)
    fold[at], folds = folds_of([keys[i] for i in at], y[at], inner)
    views = []
    for f in range(folds if folds > 1 else 0):
        rest = used & (fold != f)
        terms, marks = corpus.pick_terms(y, rest)
        x, share = corpus.features(terms, marks)
        views.append((rest, x, targets(y, share, rest)))
    terms, marks = corpus.pick_terms(y, used)
    x, share = corpus.features(terms, marks)
    labels, weights = targets(y, share, used), []
    outs = np.zeros((len(y), len(CATEGORIES)), np.float32)          # out of fold for the rows used
    said = np.zeros((len(y), 0), np.float32)                        # by the chain itself
    for k in range(len(CATEGORIES)):
        weights.append(fit(np.concatenate([x[used], outs[used, :k]], axis=1), labels[k][used]))
        said = np.concatenate([said, predict(np.concatenate([x, said], axis=1), weights[-1])[:, None].astype(np.float32)], axis=1)
        if folds == 1:
            outs[:, k] = said[:, k]
        for f, (rest, xf, lf) in enumerate(views):
            own = fold == f
            if own.any():
                w = fit(np.concatenate([xf[rest], outs[rest, :k]], axis=1), lf[k][rest])
                outs[own, k] = predict(np.concatenate([xf[own], outs[own, :k]], axis=1), w)
    return Chain(terms, marks, weights, 0.5), said[:, -1]


def train(rows: list[tuple]) -> tuple[Chain | None, dict[str, float]]:
    """The chain from (key, text, toxic) rows, and its precision and recall on rows held out.  None
    if there are not rows of both kinds.

    Every fold is scored by a chain that is made, terms and all, from the other folds; threshold, precision and recall are those of these
    probabilities.  With a single row of a kind no chain can be made without it, so they are those of the training rows."""
    rows = sorted(rows, key=lambda r: (repr(r[0]), r[1] or ""))
    keys, y = [r[0] for r in rows], np.array([float(r[2]) for r in rows], np.float32)
    if y.sum() < 1 or (1 - y).sum() < 1:
        return None, {}
    corpus = Corpus([r[1] or "" for r in rows], y)
    del rows
    chain, p = chain_of(corpus, y, np.ones(len(y), bool), keys)
    fold, folds = folds_of(keys, y)
    for f in range(folds if folds > 1 else 0):
        rest, own = fold != f, fold == f
        if own.any():
            both = 0 < y[rest].sum() < rest.sum()
            p[own] = chain_of(corpus, y, rest, keys)[1][own] if both else y[rest].mean()
    chain.threshold = max(best_threshold(p, y), EVEN)     # what is rather clean than toxic stays
    said = p >= chain.threshold
    right = float((said & (y > 0)).sum())
    return chain, {"precision": right / max(1, said.sum()), "recall": right / max(1.0, y.sum())}


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple]:
    """(doc_id, text, toxic) of at most ``sample`` toxic and twice as many other labelled rows, in
    the order of a hash of the id; rows with a null id, label or text are not drawn."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}     # a row per label value
    order = (F.xxhash64(F.lit("order"), "doc_id"), F.col("doc_id"))
    part = lambda bad, n: thinned(known.filter(F.col("toxic") == bad), held.get(bad, 0), n, "doc_id").orderBy(*order).limit(n)
    drawn = part(1, sample).unionByName(part(0, 2 * sample))
    rows = docs.select("doc_id", "text").filter(F.length("text").between(1, SAMPLE_CHARS))
    met = rows.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return [tuple(r) for r in met.select("doc_id", "text", "toxic").collect()]


def score(docs: DataFrame, chain: Chain | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, p_terms, p_sustained, p_toxic and ``toxic`` (the decision) per row.

    Null and empty texts are not toxic, nor is any text where no chain could be trained.
    Repeated rows and null ids stay; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(chain)
    (text,) = fresh(keep, "text")
    src = docs.select(*keep, F.col("text").alias(text))
    added = [f"p_{c}" for c in CATEGORIES]
    if set(keep) & {*added, "toxic"}:
        raise ValueError(f"columns to keep are named like added ones: {sorted(set(keep) & {*added, 'toxic'})}")
    schema = src.select(*keep).withColumns({c: F.lit(0.0) for c in added} | {"toxic": F.lit(False)}).schema
    own = list(keep)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        read = Features(model.terms, model.marks) if model else None

        def scored(batch):
            for i in range(0, batch.num_rows, 256):
                texts = [t for t, in rows_of(batch.slice(i, 256), text)]
                p = model.probabilities(np.stack([read.vector(t)[0] for t in texts])).astype(float) if model else np.zeros((len(texts), len(CATEGORIES)))
                for t, q in zip(texts, p.tolist()):
                    yield *q, bool(t) and model is not None and q[-1] >= model.threshold, len(t or "")

        for batch in it:
            fields = [*(pa.field(c, pa.float64()) for c in added), pa.field("toxic", pa.bool_())]
            yield from beside(batch, own, fields, scored(batch), lambda r: r[-1])

    return src.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """``score`` of ``docs`` (doc_id, text) by a chain trained on ``labels`` (doc_id, toxic)."""
    chain, _ = train(labelled_sample(docs, labels, sample))
    return score(docs, chain, keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, train_on: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows judged toxic."""
    chain, _ = train(labelled_sample(docs if train_on is None else train_on, labels))
    inner, names = shielded(docs)
    return score(inner, chain, tuple(names)).filter("NOT toxic").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
