"""Texts that contain any of many keywords, and which (FIL-7), without an alternation of them all.

Every keyword is filed under one of its q-grams, the one that the fewest texts have.  The distinct q-grams of the texts
meet these postings in an equi-join, and only pairs that share the rare q-gram are tested for the keyword itself.
A keyword that has a q-gram no text has is dropped at once.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Q = 3


def grams(text: Column, n: int) -> Column:
    """Distinct substrings of ``n`` characters."""
    return F.array_distinct(F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n))))
                            .otherwise(F.array().cast("array<string>")))


def hits(texts: DataFrame, id: str, columns: list[str], keywords: DataFrame, keyword: str = "keyword", whole_word: bool = False, q: int = Q) -> DataFrame:
    """(id, keyword): each keyword that is in some of a row's ``columns``, once per id and keyword, as ``keywords`` spells it.

    Case doesn't matter (both sides in lower case), characters are taken literally.  Null and empty keywords, and null texts, match
    nothing.  With ``whole_word`` a keyword counts only between word boundaries (D4).
    """
    known = keywords.select(F.col(keyword).alias("keyword"), F.lower(keyword).alias("_key")).where("_key <> ''").distinct()
    sizes = known.select(F.least(F.length("_key"), F.lit(q)).alias("n")).distinct().collect()        # at most q of them
    lengths = sorted(r["n"] for r in sizes)
    if not lengths:
        return texts.select(F.col(id).alias("id"), F.lit("").alias("keyword")).limit(0)
    fields = F.array(*[F.lower(F.col(c).cast("string")) for c in columns])
    rows = texts.select(F.col(id).alias("id"), F.explode(F.array_distinct(fields)).alias("_text")).where("_text IS NOT NULL")
    found = F.concat(*[grams(F.col("_text"), n) for n in lengths])
    spots = rows.withColumn("_gram", F.explode(found))
    filed = known.select("keyword", "_key", F.explode(reduce(lambda a, n: F.when(F.length("_key") == n, grams(F.col("_key"), n)).otherwise(a), lengths[:-1], grams(F.col("_key"), lengths[-1]))).alias("_gram"))
    seen = spots.join(filed.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # the rarest q-gram of each keyword; one that no text has rules the keyword out
    rare = filed.join(seen, "_gram", "left").groupBy("keyword", "_key").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_r")).where("_r.n > 0")
    met = spots.join(rare.select("keyword", "_key", F.col("_r.gram").alias("_gram")), "_gram").where(F.contains("_text", "_key"))
    if whole_word:
        met = met.where(F.regexp_like("_text", F.concat(F.lit(r"(?iu)\b\Q"), F.col("_key"), F.lit(r"\E\b"))))
    return met.select("id", "keyword").distinct()


def matching(texts: DataFrame, id: str, columns: list[str], keywords: DataFrame, **kw) -> DataFrame:
    """The rows of ``texts`` that some keyword hits, as ``catch.match_species`` gives for a short list."""
    found = hits(texts, id, columns, keywords, **kw).select(F.col("id").alias("_hit")).distinct()
    return texts.join(found, F.col(id) == F.col("_hit"), "left_semi")
