import random

import pytest

from movegrid.llm import decontaminate
from tests.llm.helpers import contaminated, docs, rows, sha


def bench(spark, items):
    return spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, words string, at int")


def check(spark, texts, items, width=10, k=5, ids=None):
    found = decontaminate.contamination(docs(spark, texts, ids), bench(spark, items), width, k)
    got = rows(decontaminate.report(found))
    want = [(i, n, hit, len(own), sha(",".join(own)), hit > 0) for i, (n, hit, own) in zip(ids or range(len(texts)), contaminated(texts, items, width))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: [f"W{rng.randrange(10 ** 6)}é" for _ in range(n)]
    items = [(i, " ".join(fresh(n))) for i, n in enumerate((10, 11, 12, 25, 60, 60, 15, 30))]
    texts = [None, "", "!?", "word"]
    for _ in range(30):
        _, t = rng.choice(items)
        w = t.split()
        a = rng.randrange(len(w))
        part = w[a:a + rng.choice([8, 9, 10, 11, 30])]
        if rng.random() < 0.3 and len(part) > 3:
            part[rng.randrange(len(part))] = "changed"
        mark = rng.choice([" ", ", ", "--", "\n"])
        texts.append(mark.join(fresh(rng.randrange(40)) + [x.upper() if rng.random() < 0.2 else x for x in part] + fresh(rng.randrange(40))))
    return texts, items


def test_matches_brute_force(spark):
    check(spark, *corpus())


def test_short_null_empty_and_repeated_items(spark):
    texts, items = corpus(2)
    texts += ["zed", "one zed two", "p q", "P-Q r p q", "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10", "a " * 40, "a b " * 30]
    items += [(50, "zed"), (51, "p q"), (51, "p q"), (52, None), (53, " ... "), (54, "k2 k3 k4 k5 k6 k7 k8 k9"), (55, "a " * 12), (100, items[3][1]), (9, items[3][1])]
    check(spark, texts, items)


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 60)
    texts, items = corpus(3)
    check(spark, texts, [*items, (70, "word")])


@pytest.mark.parametrize("width,k", [(4, 2), (3, 3), (6, 1)])
def test_other_widths(spark, width, k):
    rng = random.Random(width)
    say = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    check(spark, [say(rng.randrange(25)) for _ in range(40)], [(i, say(n)) for i, n in enumerate((0, 1, 3, 4, 6, 9))], width, k)


def test_null_item_id_marks_words_but_is_not_listed(spark):
    text = " ".join(f"w{i}" for i in range(12))
    got = rows(decontaminate.report(decontaminate.contamination(docs(spark, [text]), bench(spark, [(None, text)]))))
    assert got == [(0, 12, 12, 0, sha(""), True)]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    texts, items = corpus(4)
    check(spark, [texts[5], texts[5], None, None, texts[6]], items, ids=[1, 1, None, None, None])
    assert rows(decontaminate.contamination(docs(spark, []), bench(spark, items))) == []
    check(spark, texts[:6], [])


def test_drop_contaminated(spark):
    item = " ".join(f"w{i}" for i in range(15))
    df = docs(spark, ["x " + item, "clean text", None, "clean text"], [1, None, 3, None])
    got = decontaminate.drop_contaminated(df, bench(spark, [(1, item)]))
    assert got.columns == df.columns and sorted(r[1] or "" for r in rows(got)) == ["", "clean text", "clean text"]


def test_main_path_has_no_python(spark):
    texts, items = corpus(5)
    plan = decontaminate.contamination(docs(spark, texts).filter("doc_id >= 0"), bench(spark, items))._jdf.queryExecution().optimizedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan and "Pandas" not in plan


def mixed(seed, n_docs=60, n_items=40):
    import random
    r = random.Random(seed)
    words = ["a", "the", "to", *(f"w{i}" for i in range(40))]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 30)))) for i in range(n_items)] + [(900, None), (901, " -- "), (902, "w1 w2 w3")]
    docs = []
    for i in range(n_docs):
        t = [r.choice(words) for _ in range(r.randint(0, 80))]
        if i % 3 == 0:
            item = r.choice(items[:n_items])[1].split()
            cut = item[r.randint(0, max(0, len(item) - 10)):]
            t[r.randint(0, len(t)):0] = cut
        docs.append((i, " ".join(t)))
    return docs + [(1000, None), (1001, ""), (5, docs[5][1])], items


@pytest.mark.parametrize("block", [500_000, 10])
def test_items_of_any_length_match_sql(spark, monkeypatch, block):
    """Items of 1 to 30 words, broadcast and not, against the query's SQL."""
    import duckdb
    import pandas as pd
    from movegrid.llm import queries
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, items = mixed(3)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = sorted(con.sql(queries.ORACLE["op8_benchmark_decontamination"]).fetchall())
    df = decontaminate.report(decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert sorted(map(tuple, df.collect())) == want and any(r[-1] for r in want)


@pytest.mark.parametrize("block", [500_000, 10])
def test_documents_are_read_once_and_joins_are_not_hinted_beyond_the_block(spark, monkeypatch, tmpdir_path, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, items = mixed(4)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmpdir_path}/docs")
    found = decontaminate.contamination(spark.read.parquet(f"{tmpdir_path}/docs"), spark.createDataFrame(items, "item_id long, text string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [doc_id") == 1 and ("strategy=broadcast" in plan) == (block > 10)
