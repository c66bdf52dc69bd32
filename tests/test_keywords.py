"""Keywords as a table: postings against plain containment and against the alternation (FIL-7)."""
import random
import re

from pyspark.sql import functions as F

from movegrid.operators import catch, keywords
from movegrid.params import ELASMOBRANCH_KEYWORDS

WORDS = ["blue", "SHARK", "cray", "fish", "ray", "Ray's", "a", "ab", "abc", "Ñandú", "鲨鱼", "акула", "x.y", "(z)", "\\E", "shark-ray", "  ", "aaa", "aaaa"]


def rows(seed, n=300):
    r = random.Random(seed)
    name = lambda: None if r.random() < .1 else " ".join(r.choice(WORDS) for _ in range(r.randrange(5)))
    return [(i % (n - 5), name(), name()) for i in range(n)]


def test_hits_equal_plain_containment(spark):
    data = rows(1)
    keys = [*WORDS, "shark r", "nothing of the kind", "", None, "AAA", "aaaaa", "鲨"]
    got = sorted(map(tuple, keywords.hits(spark.createDataFrame(data, "n int, p string, q string"), "n", ["p", "q"], spark.createDataFrame([(k,) for k in keys], "keyword string")).collect()))
    want = sorted({(i, k) for i, p, q in data for k in keys if k for t in (p, q) if t is not None and k.lower() in t.lower()})
    assert got == want and want


def test_whole_words(spark):
    data = rows(2)
    keys = ["ray", "shark", "x.y", "ab", "\\E"]
    got = sorted(map(tuple, keywords.hits(spark.createDataFrame(data, "n int, p string, q string"), "n", ["p", "q"], spark.createDataFrame([(k,) for k in keys], "keyword string"), whole_word=True).collect()))
    want = sorted({(i, k) for i, p, q in data for k in keys for t in (p, q) if t is not None and re.search(rf"\b{re.escape(k)}\b", t, re.I)})
    assert got == want


def test_ten_thousand_keywords(spark):
    r = random.Random(3)
    letters = "abcdefgh"
    keys = sorted({"".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(16_000)})[:10_000]
    data = [(i, " ".join("".join(r.choice(letters + "xyz") for _ in range(r.randint(1, 12))) for _ in range(4))) for i in range(400)]
    found = keywords.hits(spark.createDataFrame(data, "n int, t string"), "n", ["t"], spark.createDataFrame([(k,) for k in keys], "keyword string"))
    want = {(i, k) for i, t in data for k in keys if k in t}
    assert len(keys) == 10_000 and {tuple(x) for x in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_same_rows_as_the_alternation(spark):
    names = ["name_en", "name_fr", "name_es", "scientific_name", "group_en"]
    data = [(i, "Blue Shark" if i % 5 == 0 else "cod", None, "Tiburón" if i % 7 == 0 else "x", "акула" if i % 3 == 0 else "", "crayfish" if i % 11 == 0 else "y") for i in range(80)]
    df = spark.createDataFrame(data, "species_code int, " + ", ".join(f"{c} string" for c in names))
    table = spark.createDataFrame([(k,) for k in ELASMOBRANCH_KEYWORDS], "keyword string")
    key = lambda d: sorted(r.species_code for r in d.collect())
    assert key(keywords.matching(df, "species_code", names, table)) == key(catch.match_species(df))


def test_empty_sides(spark):
    df = spark.createDataFrame(rows(1), "n int, p string, q string")
    some, none = spark.createDataFrame([("ray",)], "keyword string"), spark.createDataFrame([], "keyword string")
    assert keywords.hits(df, "n", ["p"], none).count() == keywords.hits(df.limit(0), "n", ["p"], some).count() == 0
    assert keywords.hits(df.withColumn("keyword", F.lit("k")), "n", ["p"], some).columns == ["id", "keyword"]
