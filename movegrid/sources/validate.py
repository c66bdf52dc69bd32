"""Input validation before a run (SRC-8): required, optional and fallback sources."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from movegrid.sources.files import listing


@dataclass(frozen=True)
class Inputs:
    tracks_csv: str
    grid_path: str | None = None
    capture_csv: str | None = None
    species_csv: str | None = None
    areas_csv: str | None = None
    image_dir: str | None = None


def count_files(spark: SparkSession, path: str | None, glob: str = "*") -> int:
    """Files under ``path`` whose names match, on any file system Spark reads; only names are
    listed.  A path that isn't there counts none."""
    return listing(spark, path, glob).count() if path else 0


def validate(spark: SparkSession, inputs: Inputs) -> DataFrame:
    """Rows (source, required, present, n_files).  A missing required source raises; the catch
    branch needs all three of its files."""
    n_tracks = count_files(spark, inputs.tracks_csv)
    if not n_tracks:
        raise FileNotFoundError(f"required track file not found: {inputs.tracks_csv}")
    n_grid = count_files(spark, inputs.grid_path)
    each = [count_files(spark, p) for p in (inputs.capture_csv, inputs.species_csv, inputs.areas_csv)]
    n_images = count_files(spark, inputs.image_dir, "*.png")
    return spark.createDataFrame([
        ("tracks", True, True, n_tracks),
        ("grid", False, n_grid > 0, n_grid),
        ("catch", False, all(each), sum(each)),
        ("images", False, n_images > 0, n_images),
    ], "source string, required boolean, present boolean, n_files long")
