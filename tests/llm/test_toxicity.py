import random

import numpy as np

from movegrid.llm import toxicity
from tests.llm.helpers import docs, rows

BAD = ["grumblet", "snorkface", "wugwit", "blatherskite"]


def labelled(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = [f"clean{rng.randrange(400)}" for _ in range(rng.randrange(5, 150))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randrange(2, 7)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD) + rng.choice(["", "s", "ish"]))
        out.append((i, " ".join(w), int(bad)))
    return out


def test_held_out_quality_and_chain():
    chain, seen = toxicity.train(labelled(900))
    assert seen["precision"] > 0.95 and seen["recall"] > 0.95
    held = labelled(600, 2)
    read = toxicity.Features(chain.terms, chain.marks)
    p = chain.probabilities(np.stack([read.vector(t)[0] for _, t, _ in held]))
    assert p.shape == (600, 3) and ((p[:, 2] >= chain.threshold) == np.array([y for *_, y in held])).mean() > 0.98
    assert [len(w) for w in chain.weights] == [len(chain.weights[0]) + i for i in range(3)]    # each sees the ones before


def test_threshold_is_the_best_f1_by_brute_force():
    rng = np.random.default_rng(1)
    y = (rng.random(200) < 0.3).astype(np.float32)
    p = np.clip(y * 0.4 + rng.random(200) * 0.6, 0, 1)
    f1 = lambda t: 2 * ((p >= t) * y).sum() / ((p >= t).sum() + y.sum())
    assert abs(f1(toxicity.best_threshold(p, y)) - max(f1(t) for t in p)) < 1e-9


def test_scores_over_awkward_rows(spark):
    rows_ = labelled(400)
    texts = [t for _, t, _ in rows_] + [None, "", " ", "wugwit " * 20_000, "wugwit grumblet", "wugwit grumblet", "plain words"]
    ids = [*range(400), 900, 901, 902, 903, None, None, 904]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows_] + [(None, 1, 1), (3, 1, None), (5, 1, rows_[5][2])], "doc_id long, quality int, toxic int")
    df = docs(spark, texts, ids).selectExpr("*", "0 AS toxic", "'x' AS p_toxic")
    got = toxicity.toxicity(df, labels)
    assert got.columns == ["doc_id", "p_terms", "p_sustained", "p_toxic", "toxic"] and got.count() == len(texts)
    by = {r[0]: r[4] for r in rows(got)}
    assert [by[i] for i in (900, 901, 902, 904)] == [False] * 4 and by[903] and by[None]
    assert np.mean([by[i] == bool(y) for i, _, y in rows_]) > 0.97
    plain = docs(spark, texts, ids)
    kept = toxicity.drop_toxic(plain, labels)
    assert kept.columns == plain.columns and {r[0] for r in rows(kept)} == {i for i, bad in by.items() if not bad}


def test_nothing_to_train_on(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs(spark, ["a", None])
    assert [r[4] for r in rows(toxicity.toxicity(df, none))] == [False, False]
    assert rows(toxicity.toxicity(docs(spark, []), none)) == []


def test_few_rows_of_a_kind_train_a_chain(spark):
    rows_ = labelled(400)
    bad, good = [r for r in rows_ if r[2]], [r for r in rows_ if not r[2]]
    for n_bad, n_good in ((1, 200), (2, 200), (3, 200), (4, 200), (60, 4), (60, 1), (1, 1)):
        some = bad[:n_bad] + good[:n_good]
        chain, seen = toxicity.train(some)
        read = toxicity.Features(chain.terms, chain.marks)
        said = chain.probabilities(np.stack([read.vector(t)[0] for _, t, _ in some]))[:, 2] >= chain.threshold
        assert said[:n_bad].mean() > 0.7 and said[n_bad:].mean() < 0.05 and set(seen) == {"precision", "recall"}
        fold, n = toxicity.folds_of([r[0] for r in some], np.array([r[2] for r in some]))
        assert n == min(n_bad, n_good) and all({y for f, (*_, y) in zip(fold, some) if f == k} == {0, 1} for k in range(n))
    assert toxicity.train(bad) == (None, {}) and toxicity.train(good) == (None, {})
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in bad[:4] + good[:200]], "doc_id long, quality int, toxic int")
    df = docs(spark, [t for _, t, _ in rows_], [i for i, *_ in rows_])
    by = dict(rows(toxicity.toxicity(df, labels).select("doc_id", "toxic")))
    assert np.mean([by[r[0]] for r in bad]) > 0.5 and np.mean([by[r[0]] for r in good]) < 0.05


def test_training_features_are_those_of_scoring():
    rows_ = labelled(120) + [(500, "", 0), (501, "Grumblet grumblets GRUMBLETISH x", 1)]
    y = np.array([b for *_, b in rows_], np.float32)
    corpus = toxicity.Corpus([t for _, t, _ in rows_], y)
    terms, marks = corpus.pick_terms(y, np.arange(len(y)) % 4 > 0)
    x, share = corpus.features(terms, marks)
    read = toxicity.Features(terms, marks)
    for i, (_, text, _) in enumerate(rows_):
        v, s = read.vector(text)
        assert np.allclose(v, x[i], atol=1e-6) and abs(s - share[i]) < 1e-9
    assert len(terms) > 3 and marks.any()


def test_random_labels_are_not_learned():
    """On labels without any meaning, held-out precision is that of guessing."""
    texts, seen = labelled(1500, 5), []
    for seed in range(6):
        rng = random.Random(seed)
        rows_ = [(i, t, int(rng.random() < 0.15)) for i, t, _ in texts]
        seen.append(toxicity.train(rows_)[1]["precision"] - sum(r[2] for r in rows_) / len(rows_))
    assert abs(np.mean(seen)) < 0.05, seen


def test_rows_left_out_have_no_part():
    rows_ = labelled(300)
    y, keys = np.array([b for *_, b in rows_], np.float32), [i for i, *_ in rows_]
    used = np.arange(300) % 3 > 0
    corpus = toxicity.Corpus([t for _, t, _ in rows_], np.ones(300))
    a = toxicity.chain_of(corpus, y, used, keys)[0]
    b = toxicity.chain_of(corpus, np.where(used, y, 1 - y), used, keys)[0]
    assert a.terms == b.terms and all((u == v).all() for u, v in zip(a.weights, b.weights))
