"""Deterministic sharded WARC writer and reader.

Writing.  Records are range-sorted by (id, payload digest) into shards whose bounds are exact quantiles of all
records, so the files depend on the records and the number of shards only, not on how the input is laid out.
A payload that an earlier id has already is written as a ``revisit`` without its bytes.  Which
rows are revisits is found on (id, digest) alone: the first id per digest is a pre-aggregated
minimum, and the join with it is a plain sort-merge join that Spark may split at hot digests.
The links so found travel as small rows of the same range sort, each sorting right before its
page, so payloads cross the network once.

A task writes records one by one, each its own gzip member, rolls to a new file once the
compressed size passes a limit, and renames each finished file from its temporary name.  Names,
record ids, dates and compression depend on the records only, so a repeated attempt of a task
rewrites the same bytes.  The manifest, one row per finished file, is written last by Spark's
own committer; readers open only files that a committed manifest lists, so files left by lost
or speculative attempts are never read.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import batches, rows_of, ship

DATE = "2024-01-01T00:00:00Z"     # fixed: two runs over the same rows give the same bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 8 << 20       # stored bytes of files that a reading task takes, if a file is no larger
MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("revisits", pa.int64()), ("first_id", pa.int64()),
                      ("last_id", pa.int64()), ("stored_bytes", pa.int64()), ("sha256", pa.string())])
MANIFEST_DDL = "file string, records long, revisits long, first_id long, last_id long, stored_bytes long, sha256 string"
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary()), ("payload_length", pa.int64()), ("payload_digest", pa.string()), ("file", pa.string())])
RECORDS_DDL = ("page_id long, url string, record_type string, refers_to long, payload binary, payload_length long, "
               "payload_digest string, file string")


def payload_bytes(html: Column) -> Column:
    return F.coalesce(html.cast("binary"), F.lit(b""))


def revisit_links(keys: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of every row whose payload of ``least`` bytes or more belongs
    to a smaller id too.  All rows that hold the smallest id of a payload are its responses."""
    large = keys.filter(F.col("size") >= least)
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (large.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to"))


def record_id(page_id, digest: str, nth: int) -> str:
    name = hashlib.sha256(f"{page_id}\n{digest}\n{nth}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def field_text(value: str) -> str:
    """A header value: percent-encodes what would end the line, and the percent sign."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain_text(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, nth: int) -> bytes:
    """One record: headers and digests made anew, then the block."""
    block = http_head(len(payload)) + (b"" if revisit else payload)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest, nth)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", field_text(url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


class Shard:
    """Files of one task: written under temporary names, rolled by size, renamed when whole."""

    def __init__(self, folder: str, part: int, attempt: int, roll: int, level: int):
        self.fs, self.root = pa.fs.FileSystem.from_uri(folder)
        self.folder, self.part, self.attempt, self.roll, self.level = folder, part, attempt, roll, level
        self.n, self.out = 0, None

    def add(self, data: bytes, page_id, revisit: bool):
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.n:05d}.warc.gz"
            self.temp = f"{self.root}/.{self.name}.{self.attempt}.tmp"
            self.fs.create_dir(self.root, recursive=True)
            self.out, self.size, self.hash = self.fs.open_output_stream(self.temp), 0, hashlib.sha256()
            self.records = self.revisits = 0
            self.first = page_id
        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)
        self.records, self.revisits, self.last = self.records + 1, self.revisits + revisit, page_id
        return self.close() if self.size >= self.roll else None

    def close(self):
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, f"{self.root}/{self.name}")
        self.out, self.n = None, self.n + 1
        return f"{self.folder}/{self.name}", self.records, self.revisits, self.first, self.last, self.size, self.hash.hexdigest()


def order_key() -> Column:
    """(page_id, digest) as one value to compare; null ids are least."""
    return F.struct(F.col("page_id").isNotNull().alias("some"), F.coalesce("page_id", F.lit(0).cast("long")).alias("id"), F.col("digest").alias("digest"))


def shard_bounds(keys: DataFrame, shards: int) -> list:
    """The keys that begin the second shard and those after it: exact quantiles of all rows in order of their key, so that they
    depend on the rows alone, not on how they are laid out.  At most ``shards`` rows reach the driver."""
    from movegrid.functions.ordering import with_global_index      # on the driver only: workers have this subpackage alone

    placed = with_global_index(keys.select(order_key().alias("key")), [F.col("key")], "place")
    n = placed.count()
    step = max(1, -(-n // shards))
    first = placed.filter((F.col("place") > 0) & (F.col("place") % step == 0)).select("place", "key").orderBy("place")
    return [r["key"] for r in first.collect()]


def shard_of(bounds: list) -> Column:
    """The shard of a row: how many bounds its key reaches."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.struct(F.lit(b["some"]).alias("some"), F.lit(b["id"]).cast("long").alias("id"), F.lit(b["digest"]).alias("digest")) for b in bounds])
    return F.size(F.filter(known, lambda b: b <= order_key()))


def write_warc(pages: DataFrame, folder: str, least: int = 100, roll_bytes: int = 256 << 20, shards: int | None = None, level: int = 6) -> str:
    """Write ``pages`` (page_id, url, html; other columns are not read) under ``folder``, a new
    path that all machines share, and return the manifest's path.

    Null html is an empty payload; null url leaves its header out; null page_id sorts first.
    Repeated rows are each written; those of a payload's smallest id are all responses.  Payloads
    under ``least`` bytes are always responses.  ``shards`` ranges (default: the session's number
    of shuffle partitions); a file is closed once it holds ``roll_bytes`` compressed.
    """
    ship(pages.sparkSession)
    html = payload_bytes(F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    links = revisit_links(rows.select("page_id", "digest", F.octet_length("payload").alias("size")), least)
    none = F.lit(None)
    every = rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload", none.cast("long").alias("refers_to")).unionByName(
        links.select("page_id", "digest", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("binary").alias("payload"), "refers_to"))
    key = ["page_id", "digest"]
    shards = shards or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = every.withColumn("shard", shard_of(shard_bounds(rows.select(*key), shards)))
    ordered = placed.repartition(shards, "shard").sortWithinPartitions("shard", *key, "kind", "url")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = None

        def files():
            nonlocal shard
            link = at = None
            for batch in it:
                for number, page_id, digest, kind, url, payload, refers_to in rows_of(batch, "shard", *key, "kind", "url", "payload", "refers_to", step=64):
                    if shard is None or shard.part != number:       # a task may hold several shards, one after the other
                        if shard is not None and (done := shard.close()):
                            yield done
                        shard = Shard(f"{folder}/data", number, task.taskAttemptId(), roll_bytes, level)
                    if kind == 0:
                        link = page_id, digest, refers_to
                        continue
                    nth = nth + 1 if at == (page_id, digest) else 0
                    at = page_id, digest
                    revisit = link is not None and link[:2] == at
                    data = record(page_id, url, payload, digest, link[2] if revisit else None, revisit, nth)
                    if done := shard.add(data, page_id, revisit):
                        yield done
            if shard is not None and (done := shard.close()):
                yield done

        yield from batches(files(), MANIFEST, lambda r: 256)

    manifest = f"{folder}/manifest"
    ordered.mapInArrow(run, MANIFEST_DDL).write.parquet(manifest)
    return manifest


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time."""
    z, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(size)):
        parts.append(z.decompress(data))
        data = b""
        if z.eof:
            yield b"".join(parts)
            data, z, parts = z.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("truncated gzip member")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; the block's length and digest must hold."""
    end = data.index(b"\r\n\r\n")
    version, *lines = data[:end].decode().split("\r\n")
    head = dict(x.split(": ", 1) for x in lines)
    block = data[end + 4:end + 4 + int(head["Content-Length"])]
    if not version.startswith("WARC/") or data[end + 4 + len(block):] != b"\r\n\r\n" or head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
    return head, block


def read_warc(spark: SparkSession, manifest: str) -> DataFrame:
    """One row per record of the files that the manifest lists; ``payload`` is null for revisits,
    whose digest and length come from their headers.  A damaged or missing file raises."""
    ship(spark)
    files = spark.read.schema(MANIFEST_DDL).parquet(manifest)

    def run(it):
        def records():
            for batch in it:
                for (name,) in rows_of(batch, "file"):
                    fs, path = pa.fs.FileSystem.from_uri(name)
                    with fs.open_input_stream(path, compression=None) as stream:
                        for data in members(stream):
                            head, block = parse(data)
                            revisit = head["WARC-Type"] == "revisit"
                            payload = None if revisit else block[block.index(b"\r\n\r\n") + 4:]
                            number = lambda k: int(head[k]) if k in head else None
                            url = plain_text(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None
                            yield (number("X-Page-ID"), url, head["WARC-Type"], number("X-Refers-To-Page-ID"), payload,
                                   number("X-Payload-Length"), head["WARC-Payload-Digest"].removeprefix("sha256:"), name)

        yield from batches(records(), RECORDS, lambda r: len(r[4] or b""))

    # a number of partitions that is asked for is kept, where a few names would be coalesced into one
    size = files.agg(F.count(F.lit(1)).alias("files"), F.sum("stored_bytes").alias("bytes")).first()
    tasks = min(size["files"], -(-(size["bytes"] or 0) // READ_BYTES), 100_000)
    return files.select("file").repartition(max(1, tasks)).mapInArrow(run, RECORDS_DDL)


def read_back(records: DataFrame) -> DataFrame:
    """The contract's columns; a response's digest and length are taken from its payload as read."""
    whole = F.col("record_type") == "response"
    return records.select(
        "page_id", F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")
