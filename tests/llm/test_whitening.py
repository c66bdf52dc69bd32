from fractions import Fraction

import numpy as np
import pytest

from movegrid.llm import queries, whitening
from tests.conftest import SF_SMALL

INF, NAN = float("inf"), float("nan")


def table(spark, vectors, kind="float"):
    return spark.createDataFrame(list(enumerate(vectors)), f"vec_id long, embedding array<{kind}>")


def exact(vectors):
    """Brute force with fractions: x, n, S, covariance matrix."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = [[Fraction(sum(r[i] * r[j] for r in y), n ** 3) for j in range(d)] for i in range(d)]
    return x, n, s, v, [sum(c * c for c in r) for r in y]


def check(rows, ids, vectors, top=32):
    x, n, s, v, dev = exact(vectors)
    v = np.array([[float(c) for c in r] for r in v])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:top], u[:, ::-1][:, :top]
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(got) == sorted(ids)
    ref = np.array([[float(Fraction(c) - Fraction(t, n)) for c, t in zip(r, s)] for r in x]) @ u / np.sqrt(e)
    for i, want, d in zip(ids, ref, dev):
        assert sorted(got[i]) == list(range(1, len(e) + 1))
        for k, r in got[i].items():
            assert (r["n"], r["deviation"]) == (n, d)
            assert abs(r["explained"] - e[k - 1] / np.trace(v)) < 1e-9
            assert abs(abs(r["whitened"]) - abs(want[k - 1])) < 1e-6
            assert r["identity_error"] < 1e-9


def test_matches_fractions(spark):
    rnd = np.random.default_rng(3)
    vectors = (rnd.normal(size=(60, 5)) * [9, 5, 3, 1, .3] + 2).round(3).tolist()
    for top in (32, 3):
        check(whitening.components(table(spark, vectors, "double").repartition(5), top=top).collect(), range(60), vectors, top)
    fits = whitening.fit(table(spark, vectors, "double"))
    _, n, s, v, _ = exact(vectors)
    again = whitening.fit(table(spark, vectors[::-1], "double").repartition(3))[5]
    assert (again.weights == fits[5].weights).all() and again.centre == fits[5].centre and again.n == n
    assert [n * c + r for c, r in zip(fits[5].centre, fits[5].rest)] == s


def test_covariance_is_rounded_once():
    rnd = np.random.default_rng(4)
    vectors = (rnd.normal(size=(40, 6)) * 50).tolist()
    x, n, s, v, _ = exact(vectors)
    z = np.array(x) - np.array([t // n for t in s])
    sums = whitening.pair_squares(z).reshape(-1)
    got = whitening.assembled(n, [t % n for t in s], {i: int(c) for i, c in enumerate(sums)})
    assert all(got[i, j] == float(v[i][j]) for i in range(6) for j in range(6))


def test_dropped_vectors_lengths_repeats_and_clashing_columns(spark):
    rnd = np.random.default_rng(5)
    good = rnd.normal(size=(30, 4)).astype(np.float32).tolist()
    short = rnd.normal(size=(9, 2)).astype(np.float32).tolist()
    bad = [None, [None, 1.0, 1.0, 1.0], [NAN, 0.0, 0.0, 0.0], [INF, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, -INF], []]
    vectors = good + good[:1] * 20 + bad + short
    rows = whitening.components(table(spark, vectors).selectExpr("*", "1 AS n", "2 AS whitened", "3 AS component", "4 AS v", "5 AS __vector")).collect()
    long_ids, short_ids = list(range(50)), list(range(56, 65))
    check([r for r in rows if r["vec_id"] < 50], long_ids, vectors[:50])
    check([r for r in rows if r["vec_id"] >= 50], short_ids, short)
    with pytest.raises(ValueError):
        whitening.components(table(spark, good).selectExpr("*", "1 AS n"), keep=("n",))
    kept = whitening.components(table(spark, good).selectExpr("*", "7 AS __vector", "8 AS __pair"), keep=("vec_id", "__vector", "__pair")).collect()
    assert {(r["__vector"], r["__pair"]) for r in kept} == {(7, 8)}


def test_empty_single_equal_and_few_vectors(spark):
    assert whitening.components(table(spark, [])).collect() == whitening.components(table(spark, [None, []])).collect() == []
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 7):
        rows = whitening.components(table(spark, vectors)).collect()
        assert len(rows) == 2 * len(vectors)
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(0, None, None, None)}
    rows = whitening.components(table(spark, [[1.0, 2.0, 3.0], [3.0, 3.0, 9.0]])).collect()
    assert [(r["whitened"] is None) for r in sorted(rows, key=lambda r: (r["vec_id"], r["component"]))] == [False, True, True] * 2
    assert all(r["identity_error"] < 1e-9 for r in rows)


def test_huge_entries_stay_exact(spark):
    vectors = [[1e12, -3e11, 5.0], [2e12, 1e11, 6.0], [-1e12, 7e11, -9.0], [5.0, 2.0, 1.0], [1e3, 8e11, 3.0]]
    fits = whitening.fit(table(spark, vectors, "double"))
    x, n, s, v, dev = exact(vectors)
    assert [n * c + r for c, r in zip(fits[3].centre, fits[3].rest)] == s
    rows = whitening.components(table(spark, vectors, "double")).collect()
    assert {r["deviation"] for r in rows} == {d if d < 2 ** 63 else None for d in dev}
    assert all(r["identity_error"] is None or r["identity_error"] < 1e-4 for r in rows)
    for r in whitening.components(table(spark, [[1e300, -1e308], [0.0, 1.0], [3.0, 1e300]], "double")).collect():
        assert r["deviation"] is None and r["n"] == 3


def test_query_on_embeddings(spark):
    vectors = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect())
    rows = queries.op13_whitening(spark, SF_SMALL).collect()
    assert len(rows) == 32 * len(vectors)
    x = np.floor(64 * np.array([v for _, v in vectors], np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    dev = dict(zip([i for i, _ in vectors], ((n * x - s) ** 2).sum(axis=1).tolist()))
    assert all(r["deviation"] == dev[r["vec_id"]] and r["n"] == n for r in rows)
    w = np.zeros((n, 32))
    at = {i: k for k, (i, _) in enumerate(vectors)}
    for r in rows:
        w[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(w.T, bias=True) - np.eye(32)).max() < 1e-9 and {r["identity_error"] for r in rows}.pop() < 1e-9
    e = np.linalg.eigvalsh(np.cov((x - 1_000_000).T, bias=True))[::-1]
    assert np.allclose([r["explained"] for r in sorted(rows, key=lambda r: (r["vec_id"], r["component"]))[:32]], e[:32] / e.sum(), rtol=1e-9)
