"""Helpers shared by the operators: shared work folder, code shipping, Arrow batch output."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

OUT_BYTES = 8 << 20   # an output batch is handed on once it holds this much
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it then gets a scratch folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="llm-work-")
        sc.setCheckpointDir(named)
    return named


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, nothing is
    kept on an executor, and a lost executor costs only a re-read."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this subpackage's source to the executors once per application, so that Python
    workers can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.basename(os.path.dirname(here))
    to = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "llm_code.zip")
    with zipfile.ZipFile(to, "w") as z:
        z.write(os.path.join(os.path.dirname(here), "__init__.py"), f"{top}/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"{top}/llm/{name}")
    spark.sparkContext.addPyFile(to)
    _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def thinned(rows: DataFrame, n: int, sample: int, *key: str) -> DataFrame:
    """About four times ``sample`` of ``n`` rows, chosen by a hash of ``key`` (all, where there are no
    more): what a top-k over many partitions sends to the driver then doesn't grow with them."""
    every = max(1, n // (4 * sample))
    return rows.filter(F.pmod(F.xxhash64(*key), F.lit(every)) == 0) if every > 1 else rows


def fresh(taken, *stems: str) -> list[str]:
    """Column names made from ``stems`` that differ from all ``taken`` ones, in any case."""
    low, out = {c.lower() for c in taken}, []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in low:
            name += "_"
        low.add(name.lower())
        out.append(name)
    return out


def batches(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Pack tuples into record batches of about ``OUT_BYTES``; ``weigh(row)`` is a row's size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row) + 64
        if size >= OUT_BYTES:
            yield _pack(held, schema)
            held, size = [], 0
    if held:
        yield _pack(held, schema)


def beside(batch: pa.RecordBatch, names: list[str], fields: list[pa.Field], made: Iterator[tuple], weigh) -> Iterator[pa.RecordBatch]:
    """The columns ``names`` of a batch, untouched, beside new columns from ``made``, a tuple per row,
    in pieces of about ``OUT_BYTES``; ``weigh(tuple)`` is a tuple's size."""
    schema, held, size, at = pa.schema([*(batch.schema.field(n) for n in names), *fields]), [], 0, 0

    def piece():
        new = (pa.array(c, f.type) for c, f in zip(zip(*held), fields))
        return pa.RecordBatch.from_arrays([*(batch.column(n).slice(at, len(held)) for n in names), *new], schema=schema)

    for row in made:
        held.append(row)
        size += weigh(row) + 64
        if size >= OUT_BYTES:
            yield piece()
            at, held, size = at + len(held), [], 0
    if held:
        yield piece()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shielded(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns under names of their own, in order, and doc_id and text besides, so that no
    column can be taken for one that an operator adds; and these names."""
    names = [f"own_column_{i}" for i in range(len(docs.columns))]
    return docs.select(*(F.col(quoted(c)).alias(n) for c, n in zip(docs.columns, names)), "doc_id", "text"), names


def _pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def rows_of(batch: pa.RecordBatch, *names: str, step: int = 256) -> Iterator[tuple]:
    """Python rows of the named columns, a few at a time, so that long texts are not all held twice."""
    cols = [batch.column(n) for n in names]
    for i in range(0, batch.num_rows, step):
        yield from zip(*(c.slice(i, step).to_pylist() for c in cols))


__all__ = ["batches", "beside", "documents", "fresh", "materialize", "quoted", "rows_of", "shared_dir", "shielded", "ship", "thinned",
           "work_path"]
