"""Token counts by the whole-token shortcut.

Offline, once per vocabulary and driver: a string of the vocabulary counts as one token where it stands
alone as a pre-token, if its merges end in exactly that token.  Each of the (bounded) strings
is proved so by running its merges; the tasks get the proof, a bit per token.  Texts are then split into pre-tokens; those proved are
counted directly, only the rest are merged.  Special strings of the file are cut out of the
text first, each counting as one token, as the library does by default.
"""
from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .bpe import Cache, Encoder, split_text
from .common import batches, rows_of, ship

_workers: dict[str, tuple] = {}
_proofs: dict[str, bytes] = {}


def byte_letters() -> dict[str, int]:
    """Letter to byte of the byte-level alphabet: printable bytes stand for themselves, the others,
    in order, for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_merges(data: bytes) -> tuple[Encoder, list[str]]:
    """Encoder (rank of a merge = its place in the list) and special strings of a tokenizer file.

    Only files that this method is proved for are taken: byte-level BPE without a normalizer,
    prefix space, dropout or added strings that swallow neighbouring space.
    """
    spec = json.loads(data)
    model, pre = spec["model"], spec["pre_tokenizer"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or not plain:
        raise ValueError("only plain byte-level BPE files are supported")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added strings with stripping or word bounds are not supported")
    letter = byte_letters()
    to_bytes = lambda s: bytes(letter[c] for c in s)
    ranks = {bytes([b]): i for i, b in enumerate(range(256))}
    for i, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        if ranks.setdefault(to_bytes(a + b), 256 + i) != 256 + i:
            raise ValueError("two merges make one string")
    return Encoder(ranks), [t["content"] for t in spec["added_tokens"]]


def whole_tokens(enc: Encoder) -> set[str]:
    """The vocabulary strings proved to be one token alone."""
    proved = set()
    for data, rank in enc.ranks.items():
        try:
            part = data.decode("utf-8")
        except UnicodeDecodeError:
            continue   # part of a character: never a pre-token
        if enc.merge(data) == [rank]:
            proved.add(part)
    return proved


def proof(data: bytes) -> bytes:
    """A bit per rank of a tokenizer file's vocabulary: whether its string is one token alone.  Made once per file."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _proofs:
        enc, _ = read_merges(data)
        one = np.zeros(len(enc.tokens), np.uint8)
        one[[enc.ranks[t.encode()] for t in whole_tokens(enc)]] = 1
        _proofs[key] = np.packbits(one).tobytes()
    return _proofs[key]


def _worker(data: bytes, proved: bytes | None = None) -> tuple:
    proved = proof(data) if proved is None else proved
    key = hashlib.sha256(data + proved).hexdigest()
    if key not in _workers:
        enc, special = read_merges(data)
        bits = np.unpackbits(np.frombuffer(proved, np.uint8))
        one = {enc.tokens[i].decode() for i in np.flatnonzero(bits)}

        def count(part: str) -> int:
            return 1 if part in one else len(enc.tree(part.encode("utf-8", "surrogatepass")))

        longest = sorted(special, key=len, reverse=True)
        cut = regex.compile("|".join(map(regex.escape, longest))) if special else None
        _workers[key] = Cache(count), cut
    return _workers[key]


def count_text(text: str | None, counts: Cache, cut) -> int:
    if not text:
        return 0
    if cut is None or not cut.search(text):
        return sum(map(counts.__getitem__, split_text(text)))
    pieces = cut.split(text)
    return len(pieces) - 1 + sum(sum(map(counts.__getitem__, split_text(p))) for p in pieces if p)


def token_counts(df: DataFrame, vocab: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Returns the columns ``keep`` and these, one row per input row; null or empty text counts
    zero of both.  ``vocab`` is a tokenizer file on the driver, broadcast (bounded by its size).
    One narrow stage, no shuffle.
    """
    spark = df.sparkSession
    ship(spark)
    with open(vocab, "rb") as f:
        data = f.read()
    shared = spark.sparkContext.broadcast((data, proof(data)))
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    src = df.select(*keep, size.alias("n_bytes"), F.col(text).alias("__text"))
    schema = src.select(*keep, "n_bytes").withColumn("n_tokens", F.lit(0).cast("long")).schema
    names = [*keep, "n_bytes"]

    def run(it):
        counts, cut = _worker(*shared.value)
        for batch in it:
            cols = pa.schema([*(batch.schema.field(n) for n in names), pa.field("n_tokens", pa.int64())])
            rows = ((*r[:-1], count_text(r[-1], counts, cut)) for r in rows_of(batch, *names, "__text"))
            yield from batches(rows, cols, lambda r: 64)

    return src.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
