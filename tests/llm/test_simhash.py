import random

from movegrid.llm import components, simhash
from tests.llm.helpers import docs, linked, rows, simhash as brute_print

BASE = " ".join(f"word{i}" for i in range(300))


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    prints = [brute_print(t) for t in texts]
    root = linked(prints, 3)
    least = {}
    for i, r in zip(ids, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, f"{p:016x}", least.get(r)) for i, p, r in zip(ids, prints, root)]
    assert sorted(rows(simhash.simhash_components(docs(spark, texts, ids))), key=repr) == sorted(want, key=repr)


def near_copies(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = BASE.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


TEXTS = [None, "", " \t\n", "One", "one", "ONE two", "one  two", "É a b c", "é a b c", *near_copies(60), BASE, BASE, "x " * 30_000, *(f"alone {i} text {i * 7} here" for i in range(40))]


def test_components_match_brute_force(spark):
    check(spark, TEXTS)


def test_null_and_repeated_ids(spark):
    check(spark, [None, "a b c", "a b c", BASE, BASE, "q r s t"], [None, None, None, 7, 7, 3])


def test_full_buckets_are_keyed_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FULL", 3)
    check(spark, TEXTS)


def test_block_masks_share_a_key_for_every_close_pair():
    rng = random.Random(2)
    for m in (4, 5, 6, 16):
        masks = [x % (1 << 64) for x in simhash.block_masks(m, 3)]
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for _ in range(3):
                b ^= 1 << rng.randrange(64)
            assert any(a & x == b & x for x in masks)


def test_keep_one_row_of_each_component(spark):
    texts = [BASE, BASE, BASE, None, "", "solo text here"]
    got = rows(simhash.keep_one(docs(spark, texts, [9, 4, 4, None, 2, 1])).select("doc_id", "text"))
    assert sorted(got) == [(1, "solo text here"), (2, ""), (4, BASE)]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (300, 200), (200, 300)]
    edges += [(rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(40)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(rows(components.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {x: find(x) for x in root if find(x) != x}


def test_empty(spark):
    assert rows(simhash.simhash_components(docs(spark, []))) == [] and rows(simhash.keep_one(docs(spark, []))) == []
