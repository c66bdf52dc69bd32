"""Image files as rows (SRC-7)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from movegrid.sources.files import listing


def read_png_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame | None:
    """``binaryFile`` scan of ``*.png`` in ``directory`` (non-recursive by default).

    A directory that is missing or holds no image gives ``None`` (nothing to catalogue).
    """
    if listing(spark, directory, "*.png").isEmpty():
        return None
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.png")
            .option("recursiveFileLookup", str(recursive).lower()).load(directory)
            .select("path", "content", "length", "modificationTime"))
