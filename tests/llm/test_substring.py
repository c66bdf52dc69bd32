import random

import pytest

from movegrid.llm import substring
from tests.llm.helpers import docs, repeats, rows, sha


def corpus(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    shared, short, run = fresh(60), fresh(35), fresh(34)
    out = [None, "", " \t ", "few words", " ".join(fresh(35)), " ".join(fresh(34))]
    for _ in range(25):      # a passage that many share, in different surroundings
        out.append(" ".join(fresh(rng.randrange(50)) + shared + fresh(rng.randrange(50))))
    for _ in range(6):       # exactly one window; one word less than a window
        out.append(" ".join(fresh(20) + short + fresh(20)))
        out.append(" ".join(fresh(20) + run + fresh(20)))
    base = fresh(300)
    for _ in range(12):      # near copies
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = fresh(1)[0]
        out.append(" ".join(w))
    out += [" ".join(base)] * 3                                  # copies
    out += [" ".join(shared + ["mid"] + shared), "a " * 200, "a b " * 90, "\n".join(fresh(80) * 2)]
    out += ["é日 " * 50 + "x", "A B " * 30, "a b " * 30]
    out.append(" ".join(fresh(3000) + shared + fresh(3000) + base))
    return out


def check(spark, texts, ids=None, width=35, k=8):
    df = docs(spark, texts, ids)
    got = rows(substring.dedup_substrings(df, width, k).select("doc_id", "n_words", "n_removed", "kept", "removed"))
    want = [(i, n, len(gone), kept) for i, (n, gone, kept) in zip(ids or range(len(texts)), repeats(texts, width))]
    assert sorted((r[:4] for r in got), key=repr) == sorted(want, key=repr)
    for i, n, gone, _, spans in got:
        assert len(spans) % 2 == 0 and sum(b - a for a, b in zip(spans[::2], spans[1::2])) == gone and spans == sorted(spans)


def test_matches_brute_force(spark):
    check(spark, corpus())


def test_hot_seeds_are_salted_with_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(substring, "LEAST_HOT", 2)
    monkeypatch.setattr(substring, "SHARE", 1)
    monkeypatch.setattr(substring, "MOST_HOT", 10 ** 9)
    texts = corpus(2)
    plain = docs(spark, texts).selectExpr("doc_id AS __id", "xxhash64(text) AS __th", "text AS __text")
    assert substring.hot_seeds(plain, 35, 8).count() > 5
    check(spark, texts)


def test_long_documents_in_overlapping_pieces(spark, monkeypatch):
    # pieces of 50 words: windows and seeds lie across their bounds (same worker code, called here)
    monkeypatch.setattr(substring, "PIECE", 50)
    texts = [t for t in corpus(3) if t]
    got = set()
    for parts, hashes in substring.pieces(((i, 0, t) for i, t in enumerate(texts)), 35):
        for r in substring.seeds_of(parts, hashes, 35, 8).to_pylist():
            got |= {(r["id"], s) for s in range(r["lo"], r["hi"] + 1)}
    want = {(i, s) for i, t in enumerate(texts) for s in range(len(t.split()) - 34)}
    assert got == want


@pytest.mark.parametrize("width,k", [(5, 2), (10, 10), (3, 1)])
def test_other_widths(spark, width, k):
    rng = random.Random(width)
    check(spark, [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30))) for _ in range(40)], width=width, k=k)


def test_null_and_repeated_ids(spark):
    t = " ".join(f"v{i}" for i in range(50))
    check(spark, [t, t, "x " + t, " ".join(f"u{i}" for i in range(50)), None], [None, None, 3, 4, 4])


def test_cut_repeats_keeps_columns_and_untouched_texts(spark):
    t = " ".join(f"v{i}" for i in range(40))
    df = docs(spark, [t + " end", "start  " + t, "not\ta repeat ", None])
    got = {r["doc_id"]: r for r in substring.cut_repeats(df).collect()}
    assert substring.cut_repeats(df).columns == df.columns
    assert [got[i]["text"] for i in range(4)] == ["end", "start", "not\ta repeat ", None]
    assert [got[i]["n_chars"] for i in range(4)] == [3, 5, 13, None]


def test_empty_and_clashing_columns(spark):
    assert rows(substring.digests(substring.dedup_substrings(docs(spark, [])))) == []
    df = spark.createDataFrame([(1, "a b", 2, "x", 4)], "doc_id long, text string, id int, th string, salt int")
    assert rows(substring.digests(substring.dedup_substrings(df))) == [(1, 2, 0, sha("a b"))]
    assert substring.cut_repeats(df).columns == df.columns
