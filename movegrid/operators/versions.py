"""Exports as versions: an output is seen whole or not at all, and the one before stays until it is dropped.

Below a root, every export writes its tables to a folder of its own, ``versions/<commit>/<table>``.  Only when
all are written is its manifest, ``_manifest/<number>.json``, moved to its place: a line per table.  Readers go by the
manifests alone, so an export that fails half way changes nothing for them.  Two exports that end at once can't
take one number; the second is told so.
"""
from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "version long, commit string, table string, folder string, format string, created double"


class Conflict(RuntimeError):
    """Another export was committed under the number that this one was to have."""


class Store:
    """Files of a root on any file system that Spark reaches; used for names and manifests only, never for data."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> dict[str, float]:
        """Entries of a folder and when they changed, in seconds."""
        if not self.exists(folder):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.fs.listStatus(self.path(folder))}

    def put(self, name: str, data: str) -> bool:
        """Create a file in one step; False if there is one of that name."""
        temp = f"_manifest/.{uuid.uuid4().hex}"
        out = self.fs.create(self.path(temp), False)
        out.write(bytearray(data.encode()))
        out.close()
        if not self.exists(name) and self.fs.rename(self.path(temp), self.path(name)):
            return True
        self.fs.delete(self.path(temp), False)
        return False

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"can't move {old} to {new}")

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _number(name: str) -> int | None:
    stem, _, kind = name.partition(".")
    return int(stem) if kind == "json" and stem.isdigit() else None


def numbers(store: Store) -> list[int]:
    return sorted(n for n in map(_number, store.names("_manifest")) if n is not None)


def _manifest(n: int) -> str:
    return f"_manifest/{n:012d}.json"


@dataclass
class Export:
    """``with Export(spark, root) as e: df.write.parquet(e.folder("name"))`` - committed at the end of the block, unless it raises."""

    spark: SparkSession
    root: str
    commit: str = field(default_factory=lambda: uuid.uuid4().hex)
    version: int | None = None
    tables: dict = field(default_factory=dict)

    def carry(self, version: int | None = None) -> Export:
        """Take the tables of the last version (or another) over into this one, without copying them; a table written anew replaces its own."""
        store = Store(self.spark, self.root)
        known = numbers(store)
        if known:
            for r in self.spark.read.schema(MANIFEST).json(f"{store.root}/{_manifest(version or known[-1])}").collect():
                self.tables[r["table"]] = r["folder"], r["format"]
        return self

    def folder(self, table: str, fmt: str = "parquet") -> str:
        """Where to write a table of this export; to be written once, in the format given."""
        if self.tables.get(table, ("",))[0].startswith(f"versions/{self.commit}/") or "/" in table or not table:
            raise ValueError(f"table {table!r} is named twice or can't be a folder")
        self.tables[table] = f"versions/{self.commit}/{table}", fmt
        return f"{self.root.rstrip('/')}/{self.tables[table][0]}"

    def __enter__(self) -> Export:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            return
        store = Store(self.spark, self.root)
        missing = [t for t, (folder, _) in self.tables.items() if not store.exists(folder)]
        if missing:
            raise FileNotFoundError(f"tables of the export were not written: {missing}")
        n = (numbers(store) or [0])[-1] + 1
        rows = [dict(version=n, commit=self.commit, table=t, folder=folder, format=fmt, created=time.time()) for t, (folder, fmt) in self.tables.items()]
        if not store.put(_manifest(n), "".join(json.dumps(r) + "\n" for r in rows)):
            raise Conflict(f"version {n} of {self.root} was committed by another export")
        self.version = n


def history(spark: SparkSession, root: str) -> DataFrame:
    """A row per table of every committed version."""
    store = Store(spark, root)
    files = [f"{store.root}/{_manifest(n)}" for n in numbers(store)]
    return spark.read.schema(MANIFEST).json(files) if files else spark.createDataFrame([], MANIFEST)


def resolve(spark: SparkSession, root: str, version: int | None = None) -> dict[str, tuple[str, str]]:
    """{table: (path, format)} of a version, by default the last; LookupError if there is none."""
    store = Store(spark, root)
    known = numbers(store)
    n = version if version is not None else known[-1] if known else None
    if n not in known:
        raise LookupError(f"no version {'' if version is None else version} at {root}")
    held = spark.read.schema(MANIFEST).json(f"{store.root}/{_manifest(n)}").collect()       # a row per table of one export
    return {r["table"]: (f"{store.root}/{r['folder']}", r["format"]) for r in held}


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the last version, or of an earlier one that wasn't dropped."""
    path, fmt = resolve(spark, root, version)[table]
    reader = spark.read.format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


def drop_old(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
    """Drop all but the last ``keep`` versions, and what failed exports left more than ``grace_hours`` ago; the folders dropped.

    A version's manifest goes before its data, so no reader finds a version without data.  Folders that no manifest
    names and that are younger than the grace may belong to an export still under way and stay."""
    if keep < 1:
        raise ValueError("the last version can't be dropped")
    store = Store(spark, root)
    known = numbers(store)
    named = {(r["version"], r["folder"].split("/")[1]) for r in history(spark, root).select("version", "folder").distinct().collect()}
    last, gone, now = set(known[-keep:]), [], time.time()
    for n in known[:-keep]:
        store.drop(_manifest(n))
    held, dropped = {c for n, c in named if n in last}, {c for n, c in named if n not in last}
    for name, changed in store.names("versions").items():
        if name not in held and (name in dropped or now - changed > grace_hours * 3600):
            store.drop(f"versions/{name}")
            gone.append(f"versions/{name}")
    return sorted(gone)


def replace(spark: SparkSession, path: str, write) -> str:
    """Let ``write(folder)`` write beside ``path`` and put the result in its place when it is whole; a failure before that leaves
    ``path`` as it was.  Between taking the old folder away and moving the new one in, both are there under other names."""
    parent, _, name = path.rstrip("/").rpartition("/")
    store, tag = Store(spark, parent or "."), uuid.uuid4().hex
    new, old = f"_{name}.new-{tag}", f"_{name}.old-{tag}"
    try:
        write(f"{store.root}/{new}")
    except BaseException:
        store.drop(new)
        raise
    if store.exists(name):
        store.move(name, old)
    store.move(new, name)
    store.drop(old)
    return path
