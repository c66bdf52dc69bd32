"""File listings as tables: path, length and modification time, found by Spark's own listing.

Any store that Spark reads is listed, folder level by folder level, by tasks where a level has many
folders; patterns are applied while listing and no content is read.
"""
from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

GRID_PATTERN = "{*.nc,*.nc4,*.netcdf,*.NC}"
cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks get these functions with their closures
SCHEMA = "path string, length long, modified timestamp"


def listing(spark: SparkSession, paths: str | list[str], pattern: str = "*", recursive: bool = True) -> DataFrame:
    """SRC-3: (path, length, modified) of the files at or below ``paths`` whose names match ``pattern``.

    A path that doesn't exist, or holds no such file, gives no rows, nor does a file without a byte.
    A file reached over two of the paths is
    listed once (SET-2, D23).
    """
    def found(some: list[str]) -> DataFrame:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
        return reader.load(some).select("path", "length", F.col("modificationTime").alias("modified"))

    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    for some in [paths] if len(paths) < 2 else [paths, *([p] for p in paths)]:
        try:
            parts.append(found(some))
            if some is paths:
                break
        except PySparkException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    once = len(paths) == 1 and not re.search(r"[*?\[{]", paths[0])       # one folder or file is listed once
    return parts[0] if once else reduce(DataFrame.unionByName, parts).distinct()


def target(folder: str):
    """(file system, place) of a path or URI."""
    uri = re.sub(r"^file:/+", "file:///", folder) if folder.startswith("file:") else folder
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_whole(fs, root: str, name: str, data: bytes) -> None:
    """One file, under a temporary name first, so that a repeated task leaves it whole."""
    temp = f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(temp) as out:
        out.write(data)
    fs.move(temp, f"{root}/{name}")


def write_bytes(files: DataFrame, folder: str) -> DataFrame:
    """Write a file per row of ``files`` (name, content; null content: empty) under ``folder``; gives (path, length)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = target(folder)
        fs.create_dir(root, recursive=True)
        for batch in it:
            out = []
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or b""
                write_whole(fs, root, name, data)
                out.append((f"{folder.rstrip('/')}/{name}", len(data)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64()))], ["path", "length"])

    return files.select("name", "content").mapInArrow(run, "path string, length long")
