"""Benchmark decontamination by winnowing, in DataFrame operations only.

Every text becomes an array of words and an array of k-gram hashes.  Of every ``width - k + 1``
neighbouring k-grams the least hash (all of them, on ties) is a fingerprint; since this depends
only on those words, two equal spans of ``width`` words always share a fingerprint at the same
place.  Training fingerprints are joined with the benchmark's, and each hit is extended word by
word to both sides; it counts if the equal words around it make a whole window.

Items shorter than a window are one window of their own length; they are filed under a hash of it, and for each such
length that there is, the texts' n-grams of that length join in the same pass, so texts are read and split once.

A benchmark of at most ``BLOCK`` words is broadcast and texts are not shuffled before the join; a larger one meets the
fingerprints in a shuffled join, which adaptive execution splits at hot ones.  Only matches and one row per document reach the
aggregation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 500_000      # words of the largest benchmark whose fingerprints are broadcast


def words_of(text: Column) -> Column:
    """Array of words of a text, A-Z lower-cased; null has none."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    parts = F.split(low, BETWEEN_WORDS)
    lead = (F.get(parts, F.lit(0)) == "").cast("int")
    trail = (F.element_at(parts, -1) == "").cast("int")
    return F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - trail, F.lit(0)))


def gram_hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*(F.get(words, at + c) for c in range(k)))


def gram_hashes(words: Column, k: int) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) < k, none).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: gram_hash(words, i, k)))


def run_length(holds: list[Column]) -> Column:
    """How many of the conditions hold from the first on."""
    out = F.lit(len(holds))
    for n in reversed(range(len(holds))):
        out = F.when(F.coalesce(holds[n], F.lit(False)), out).otherwise(F.lit(n))
    return out


def is_fingerprint(hashes: Column, at: Column, span: int) -> Column:
    """Whether the hash at ``at`` is the least of some ``span`` neighbouring hashes."""
    own = F.get(hashes, at)
    left = run_length([F.get(hashes, at - c) >= own for c in range(1, span)])
    right = run_length([F.get(hashes, at + c) >= own for c in range(1, span)])
    return left + right + 1 >= span


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", words_of(F.col("text")).alias("item_words"))


def _around(words: Column, at: Column, width: int, k: int) -> Column:
    """The words that a window with its fingerprint at ``at`` can reach."""
    return F.array(*(F.get(words, at + c) for c in range(k - width, width)))


def _prints(items: DataFrame, width: int, k: int) -> DataFrame:
    """Benchmark side of the join: hash, words around the place, words a match must have, item_id: a row per fingerprint of
    items of ``width`` words and more, and one per shorter item, whose hash takes in its length."""
    at = F.col("at")
    wide = (items.filter(F.size("item_words") >= width).withColumn("hashes", gram_hashes(F.col("item_words"), k))
            .select("*", F.explode(F.sequence(F.lit(0), F.size("hashes") - 1)).alias("at"))
            .filter(is_fingerprint(F.col("hashes"), at, width - k + 1))
            .select(F.get("hashes", at).alias("hash"), _around(F.col("item_words"), at, width, k).alias("near"),
                    F.lit(k).alias("right_least"), F.lit(width).alias("least"), "item_id"))
    size = F.size("item_words")
    short = items.filter(size.between(1, width - 1)).select(
        F.xxhash64(size, *(F.get("item_words", F.lit(c)) for c in range(width - 1))).alias("hash"),
        _around(F.col("item_words"), F.lit(0), width, k).alias("near"), size.alias("right_least"), size.alias("least"), "item_id")
    return wide.unionByName(short)


def _spots(texts: DataFrame, lengths: list[int], width: int, k: int) -> DataFrame:
    """Training side, in one pass over the texts: a row per document (``at`` -1, a hash of its own that no item has), one per
    fingerprint, and one per place and length of ``lengths``; each carries only the words around it."""
    at, words, hashes = F.col("at"), F.col("words"), F.col("hashes")
    every = texts.withColumn("hashes", gram_hashes(words, k)).select("*", F.explode(F.sequence(F.lit(-1), F.size(words if lengths else hashes) - 1)).alias("at"))
    print_ = (at >= 0) & is_fingerprint(hashes, at, width - k + 1)
    own = F.when(at < 0, F.xxhash64("doc_id", "text_hash")).otherwise(F.get(hashes, at))
    if not lengths:
        found = every.filter((at < 0) | print_).withColumn("hash", own)
    else:
        # a hash passes over nulls, so that of a shorter item ends with its words
        gram = lambda n: F.xxhash64(F.lit(n), *(F.get(words, at + c) for c in range(n)))
        keys = [F.when((at < 0) | print_, own), *(F.when((at >= 0) & (at + n <= F.size(words)), gram(n)) for n in lengths)]
        found = every.withColumn("hash", F.explode(F.array_compact(F.array(*keys))))
    return found.select("doc_id", "text_hash", F.size(words).alias("n_words"), at.alias("at"), "hash", _around(words, at, width, k).alias("seen"))


def _matches(spots: DataFrame, prints: DataFrame, width: int, k: int) -> DataFrame:
    """One row per document (no range) and one per extended match: [start, stop) and item_id."""
    reach, at = width - k, F.col("at")
    met = spots.join(prints, "hash", "left").filter((at < 0) | F.col("near").isNotNull())
    # higher-order functions keep the generated code of the scan and the join small enough to be compiled; few rows get here
    def equal_words(places: Column, most: int) -> Column:
        same = F.transform(places, lambda i: F.coalesce(F.get("seen", i) == F.get("near", i), F.lit(False)))
        first = F.array_position(same, False).cast("int")
        return F.when(first == 0, F.lit(most)).otherwise(first - 1)

    left = equal_words(F.sequence(F.lit(reach - 1), F.lit(0), F.lit(-1)), reach) if reach else F.lit(0)
    right = equal_words(F.sequence(F.lit(reach), F.lit(reach + width - 1)), width)
    found = met.select("doc_id", "text_hash", "n_words", "at", "item_id", "right_least", "least", left.alias("left"), right.alias("right"))
    return found.filter("at < 0 OR (right >= right_least AND left + right >= least)").select(
        "doc_id", "text_hash", "n_words", F.when(at >= 0, at - F.col("left")).alias("start"),
        F.when(at >= 0, at + F.col("right")).alias("stop"), F.when(at >= 0, F.col("item_id")).alias("item_id"))


def _covered(ranges: Column) -> Column:
    """Number of places that sorted ranges cover."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0), r["stop"] - F.greatest(r["start"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], r["stop"]).alias("end"))
    return F.aggregate(ranges, start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, k: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, n_hit, ranges (hit word
    ranges), items (sorted item ids as strings), contaminated.

    A document word is hit if it lies in an occurrence of a window of ``width`` consecutive words
    of an item; an item of fewer words, but not none, is one window.  Null texts have no words.
    Repeated rows each get their row; null doc_ids are kept.  Items with a null id mark words but
    are not listed, and repeated item ids are listed once.  Other columns are not read.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    items = _items(benchmark)
    size = items.agg(F.coalesce(F.sum(F.size("item_words")), F.lit(0)).alias("words"),
                     F.sort_array(F.collect_set(F.when(F.size("item_words").between(1, width - 1), F.size("item_words")))).alias("short")).first()
    prints = _prints(items, width, k)
    found = _matches(_spots(texts, size["short"], width, k), F.broadcast(prints) if size["words"] <= BLOCK else prints, width, k)
    by_doc = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count_if(F.col("start").isNull()).alias("rows"),
        F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop")))).alias("ranges"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return by_doc.select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), _covered(F.col("ranges")).alias("n_hit"),
                         "ranges", "items", (F.size("ranges") > 0).alias("contaminated"), "rows").withColumn(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("row", "rows")


def report(found: DataFrame) -> DataFrame:
    """The contract's columns of ``contamination``."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, k: int = 5) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    own, bad_id, bad_hash = fresh(docs.columns, "hash", "bad_id", "bad_hash")
    bad = contamination(docs.select("doc_id", "text"), benchmark, width, k).filter("contaminated").select(
        F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    hit = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.col(own) == F.col(bad_hash))
    return docs.withColumn(own, F.xxhash64("text")).join(bad, hit, "left_anti").select(*map(quoted, docs.columns))
