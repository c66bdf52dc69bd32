import numpy as np

from movegrid.llm import ann
from tests.llm.helpers import rows

DDL = "vec_id long, embedding array<float>, label int, score string, rank string"


def table(spark, pairs):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "s", "r") for i, v in pairs], DDL)


def brute(pairs, queries, top):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in pairs if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i in queries:
            near = sorted((-(w * v).sum(), j) for j, w in ok if j != i and len(w) == len(v))
            out[i] = [j for _, j in near[:top]]
    return out


def found(spark, pairs, queries, top=20, **how):
    df = table(spark, pairs)
    out = {}
    for q, rank, j, score in sorted(rows(ann.nearest(df, df.filter(df.vec_id.isin(list(queries))), top, **how).select("query_id", "rank", "vec_id", "score"))):
        out.setdefault(q, []).append((rank, j, score))
    assert all([r for r, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [j for _, j, _ in v] for q, v in out.items()}, out


def clusters(n, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = centres[rng.integers(0, 8, n)] + 0.6 * rng.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_recall_and_exact_scores(spark):
    x = clusters(3000)
    pairs = list(enumerate(x.tolist()))
    queries = set(range(0, 3000, 50))
    got, full = found(spark, pairs, queries)
    want = brute(pairs, queries, 20)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.9
    assert all(abs(s - float((x[q].astype(float) * x[j].astype(float)).sum())) < 1e-12 for q, v in full.items() for _, j, s in v)


def test_all_probes_are_exact_with_ties_copies_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 7)
    x = clusters(150, 2, 4).tolist()
    pairs = list(enumerate(x + [x[0]] * 40 + [x[1]] * 3)) + [(0, x[0])]
    queries = {0, 1, 2, 150, 151, 189, 191, 77}
    assert found(spark, pairs, queries, top=5, tables=1, probes=8)[0] == brute(pairs[:-1], queries, 5)


def test_unusable_vectors_take_no_part(spark):
    good = [(1, [1, 0, 0, 0]), (2, [0.5, 0.5, 0, 0]), (3, [0, 0, 1, 1]), (-20, [1, 1, 1, 1])]
    bad = [(10, None), (11, []), (12, [0, 0, 0, 0]), (13, [1, None, 0, 0]), (14, [float("nan"), 1, 0, 0]), (15, [float("inf"), 1, 0, 0]), (None, [1, 0, 0, 0])]
    other = [(40, [1, 2]), (41, [2, 1])]
    queries = {1, 10, 11, 12, 13, 14, 15, -20, 40}
    got, _ = found(spark, good + bad + other, queries, tables=2, probes=8)
    assert got == brute(good + bad + other, queries, 20) and got[40] == [41]


def test_more_hashes_use_multiprobe(spark):
    pairs = list(enumerate(clusters(400, 3, 8).tolist()))
    queries = set(range(0, 400, 20))
    assert found(spark, pairs, queries, tables=1, hashes=2, probes=256)[0] == brute(pairs, queries, 20)


def test_empty_and_single(spark):
    assert found(spark, [], {1})[0] == {} and found(spark, [(1, [1, 2])], {1})[0] == {}


def test_queries_whose_probes_reach_too_few_are_searched_exactly(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(5)
    few = list(enumerate(rng.normal(size=(20, 64)).tolist()))
    assert all(len(v) == 19 for v in found(spark, few, set(range(20)))[0].values())
    centre = rng.normal(size=64)
    near = lambda c, n: (c + 0.05 * rng.normal(size=(n, 64))).tolist()
    pairs = list(enumerate(near(-centre, 600) + near(centre, 10) + rng.normal(size=(40, 32)).tolist()))
    queries = {3, *range(600, 650)}
    got, full = found(spark, pairs, queries)
    want = brute(pairs, queries, 20)
    assert all(len(got[q]) == 20 for q in queries) and all(got[q] == want[q] for q in range(600, 610))
    assert len(full) == len(queries)


def test_exact_search_alone_is_brute_force_with_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 3)
    x = clusters(40, 2, 4).tolist()
    pairs = list(enumerate(x + [x[0]] * 12 + [x[1]] * 3))
    queries = {0, 1, 2, 40, 41, 52, 30}
    assert found(spark, pairs, queries, top=50, tables=1, probes=1)[0] == brute(pairs, queries, 50)


def test_huge_and_tiny_components_lose_no_row(spark):
    rng = np.random.default_rng(6)
    ddl = "vec_id long, embedding array<double>"
    for scale in (1e200, 1e-200, 1e307):
        x = rng.normal(size=(60, 4)) * scale
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], ddl)
        got = rows(ann.nearest(df, df.filter("vec_id < 3"), 20).select("query_id", "vec_id", "score"))
        assert sorted({q: sum(1 for r in got if r[0] == q) for q, *_ in got}.items()) == [(0, 20), (1, 20), (2, 20)]
        y = x / scale
        with np.errstate(over="ignore"):
            sums = (y[:3] @ y.T) * scale * scale
        for q, j, s in got:
            assert s == sums[q, j] or abs(s - sums[q, j]) <= 1e-9 * abs(sums[q, j]) or scale < 1e-100
        want = {q: sorted((-round(sums[q, j], 12) if np.isfinite(sums[q, j]) and scale > 1 else -sums[q, j], j) for j in range(60) if j != q)[:20] for q in range(3)}
        if scale > 1:        # products beyond a double's range are infinite and tie
            assert {q: [j for a, j, _ in sorted(((-s, j, a) for a, j, s in got if a == q))] for q in range(3)} == {q: [j for _, j in v] for q, v in want.items()}


def test_vectors_of_mixed_size_are_ranked_exactly():
    rng = np.random.default_rng(8)
    vecs = rng.normal(size=(400, 8)) * 10.0 ** rng.integers(-160, 150, (400, 1))
    queries = rng.normal(size=(5, 8)) * 10.0 ** rng.integers(-100, 100, (5, 1))
    for q, found in ann.best_of(np.arange(400), vecs, queries, 15):
        exact = sorted(((-float((queries[q] * v).sum()), i) for i, v in enumerate(vecs)))[:15]
        assert [i for i, _ in found] == [i for _, i in exact]


def test_ties_are_scored_in_slices_of_bounded_size():
    import tracemalloc
    vecs = (np.random.default_rng(2).random((16_384, 768)) < 0.5).astype(float)
    queries = np.eye(64, 768)
    tracemalloc.start()
    out = dict(ann.best_of(np.arange(16_384), vecs, queries, 21))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * vecs.nbytes and all([i for i, _ in v] == np.flatnonzero(vecs[:, q])[:21].tolist() for q, v in out.items())


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    held = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    ids, x = [i for i, _ in held], np.array([v for _, v in held], float)
    got = {}
    for q, j in rows(ann.nearest(df, df.filter("vec_id % 20 = 0"), 20).select("query_id", "vec_id")):
        got.setdefault(q, set()).add(j)
    hit = 0
    for q in got:
        s = x @ x[ids.index(q)]
        near = [ids[k] for k in sorted(range(len(ids)), key=lambda k: (-s[k], ids[k])) if ids[k] != q]
        hit += len(got[q] & set(near[:20]))
    assert len(got) == sum(i % 20 == 0 for i in ids) and hit / (20 * len(got)) >= 0.95
