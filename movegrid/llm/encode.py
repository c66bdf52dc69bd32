"""Byte-level BPE encoding and decoding of a text column by tree reduction (method in ``bpe``).

One narrow stage without a shuffle: every row is encoded where it is read.  A worker holds the
vocabulary (bounded by its file), a bounded cache of pre-tokens and one batch.
"""
from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import Cache, Encoder, read_ranks, split_text
from .common import batches, rows_of, ship

LEAF = 4_096         # ids decoded at once
_workers: dict[str, tuple] = {}


def _worker(data: bytes) -> tuple:
    key = hashlib.sha256(data).hexdigest()
    if key not in _workers:
        enc = Encoder(read_ranks(data))
        packed = Cache(lambda part: pack(enc.encode_part(part)))
        _workers[key] = enc, packed
    return _workers[key]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode_bytes(text: str | None, packed: Cache) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers; empty for null."""
    return b"".join(map(packed.__getitem__, split_text(text))) if text else b""


def decode_bytes(ids: bytes | None, tokens: list[bytes]) -> bytes:
    """The bytes of ids, up the tree: leaves of ``LEAF`` ids are decoded, then neighbours are joined until one is left."""
    every = np.frombuffer(ids or b"", "<u4")
    parts = [b"".join(map(tokens.__getitem__, every[i:i + LEAF].tolist())) for i in range(0, len(every), LEAF)]
    while len(parts) > 1:
        parts = [b"".join(parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0] if parts else b""


def encode(df: DataFrame, vocab: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "ids") -> DataFrame:
    """Add ``out``: the ids of ``text`` packed as little-endian unsigned 32-bit integers.

    ``vocab`` is the path of a rank file on the driver; its bytes are broadcast (bounded by the
    vocabulary).  Returns the columns ``keep`` and ``out``, one row per input row (repeated rows
    stay); other columns, whatever their names, are not read.  Null or empty text has no ids.
    """
    spark = df.sparkSession
    ship(spark)
    with open(vocab, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    src = df.select(*keep, F.col(text).alias("__text"))
    schema = src.select(*keep).withColumn(out, F.lit(b"")).schema
    names = list(keep)

    def run(it):
        _, packed = _worker(shared.value)
        for batch in it:
            cols = pa.schema([*(batch.schema.field(n) for n in names), pa.field(out, pa.binary())])
            rows = ((*r[:-1], encode_bytes(r[-1], packed)) for r in rows_of(batch, *names, "__text"))
            yield from batches(rows, cols, lambda r: len(r[-1]))

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, vocab: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id", "ids"), out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes of the packed ``ids`` (null: empty), beside the columns ``keep``.

    An id outside the vocabulary raises: ids are never dropped.
    """
    spark = df.sparkSession
    ship(spark)
    with open(vocab, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    src = df.select(*keep, F.col(ids).alias("__ids"))
    schema = src.select(*keep).withColumn(out, F.lit(b"")).schema
    names = list(keep)

    def run(it):
        enc, _ = _worker(shared.value)
        for batch in it:
            cols = pa.schema([*(batch.schema.field(n) for n in names), pa.field(out, pa.binary())])
            rows = ((*r[:-1], decode_bytes(r[-1], enc.tokens)) for r in rows_of(batch, *names, "__ids"))
            yield from batches(rows, cols, lambda r: len(r[-1]))

    return src.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocab: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``encode`` and then ``decode`` of its ids, both in one pass of the workers, which hold the
    vocabulary once: the columns ``keep``, ids and decoded."""
    spark = df.sparkSession
    ship(spark)
    with open(vocab, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    src = df.select(*keep, F.col(text).alias("__text"))
    schema = src.select(*keep).withColumns({"ids": F.lit(b""), "decoded": F.lit(b"")}).schema
    names = list(keep)

    def run(it):
        enc, packed = _worker(shared.value)

        def rows(batch):
            for *own, value in rows_of(batch, *names, "__text"):
                ids = encode_bytes(value, packed)
                yield *own, ids, decode_bytes(ids, enc.tokens)

        for batch in it:
            cols = pa.schema([*(batch.schema.field(n) for n in names), pa.field("ids", pa.binary()), pa.field("decoded", pa.binary())])
            yield from batches(rows(batch), cols, lambda r: len(r[-1]) + len(r[-2]))

    return src.mapInArrow(run, schema)


def digests(docs: DataFrame, vocab: str) -> DataFrame:
    """Per document: token count and SHA-256 of the packed ids and of the decoded bytes."""
    return round_trip(docs, vocab).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
