import random
import zlib

import numpy as np

from movegrid.llm import langid, queries
from tests.llm import helpers

WORDS = {"xx": ["kalo", "miru", "tesan", "vola", "nekti"], "yy": ["ström", "flöde", "gård", "hjärta", "blå"], "zz": ["что", "слово", "река", "дом", "лес"]}


def text_of(lang, n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def corpus():
    return [(i, text_of(lang, 5 + i % 40, i), lang) for i, lang in enumerate(sorted(WORDS) * 40)]


def grams(text):
    """Brute force: n-gram counts by place."""
    s, last = [" "], " "
    for c in text:
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if c != " " or last != " ":
            s.append(c)
        last = c
    if s[-1] != " ":
        s.append(" ")
    out, mask = np.zeros(langid.PLACES, np.int64), (1 << 64) - 1
    for n in langid.LENGTHS:
        for i in range(len(s) - n + 1):
            acc = (ord(s[i]) + 1) * int(langid._MIX) & mask
            for c in s[i + 1:i + n]:
                acc = (acc ^ (ord(c) + 1)) * int(langid._STEP) * int(langid._MIX) & mask
            out[((acc + n) * int(langid._MIX) & mask) >> int(langid._SHIFT)] += 1
    return out


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Ab, c'd  ÄÖ. İx 日本! \n -- " * 7
    want = grams(text)
    for piece in (langid.PIECE, 1, 2, 3, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert (langid.counts(text)[0] == want).all()
    assert langid.counts(None)[1] == langid.counts(" 12 ?")[1] == 0


def test_learned_languages_unknown_texts_and_rejection(spark):
    model = langid.fit(table(spark, corpus()))
    assert model.languages == sorted(WORDS)
    assert np.allclose(np.linalg.norm(model.centroids, axis=0), 1, atol=1e-4) and len(model.owner) > len(WORDS)
    asked = [(1000 + i, text_of(lang, 30, 999 - i), lang) for i, lang in enumerate(sorted(WORDS) * 5)]
    asked += [(1, None, None), (2, "", None), (3, "12 34 -- !", None), (4, "∀𝟙", None), (5, "wxyz qqq jjj " * 50, None), (5, "wxyz qqq jjj " * 50, None)]
    got = langid.identify(table(spark, asked).selectExpr("*", "'k' AS __text"), model, keep=("doc_id", "lang", "__text")).collect()
    assert len(got) == len(asked) and {r["__text"] for r in got} == {"k"}
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] >= 1000:
            assert r["lang_pred"] == r["lang"] and not r["rejected"]
        elif r["doc_id"] == 5:
            assert r["lang_pred"] in WORDS and r["rejected"]
        else:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)


def test_cosine_is_that_of_the_vectors(spark):
    rows = corpus()
    model = langid.fit(table(spark, rows))
    df = sum((grams(t) > 0).astype(int) for _, t, _ in rows)
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + df)) + 1, rtol=1e-5)
    v = np.log1p(grams(rows[3][1])) * model.idf
    (got,) = langid.identify(table(spark, [rows[3]]), model).collect()
    assert abs(got["score"] - (v / np.linalg.norm(v) @ model.centroids).max()) < 1e-4


def test_held_out_rows_teach_nothing(spark):
    rows = corpus()
    wrong = [(i, t, lang if zlib.crc32(str(i).encode()) % 3 != 1 else "no") for i, t, lang in rows]
    wrong += [(None, "что слово", "no"), (7_000_001, None, "no"), (7_000_002, "abc", None)]
    got = langid.languages(table(spark, wrong).selectExpr("*", "1 AS source", "2 AS place", "true AS held_out")).collect()
    assert len(got) == len(wrong) and all(r["lang_pred"] in {*WORDS, "und"} for r in got)
    assert {r["doc_id"] for r in got if r["held_out"]} == {i for i, *_ in wrong if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}
    right = {i: lang for i, _, lang in rows}
    assert all(r["lang_pred"] == right[r["doc_id"]] for r in got if r["doc_id"] in right)


def test_empty_tables_no_labels_one_hot_id_and_layouts(spark):
    assert langid.languages(table(spark, [])).collect() == []
    (r,) = langid.languages(table(spark, [(2, "some text", None)])).collect()
    assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    rows = corpus() + [(1, text_of("xx", 9, 1), "xx")] * 300
    one = langid.fit(table(spark, rows).repartition(7), sample=8)
    two = langid.fit(table(spark, rows[::-1]).repartition(2), sample=8)
    assert (one.centroids == two.centroids).all() and (one.idf == two.idf).all() and (one.lowest == two.lowest).all()


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in queries.op11_language_id(spark, sf).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert len(got) > 250 and sum(lang[r["doc_id"]] == r["lang_pred"] for r in got) >= 0.99 * len(got)
    assert sum(r["rejected"] for r in got) <= 0.05 * len(got)
    assert helpers.rows(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("count(*)"))[0][0] == len(lang)
