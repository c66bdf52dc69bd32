"""The whole run over files: the tables are written as the files a user would have - CSV with published headers, NetCDF grids,
PNG images - and ``pipeline.run`` reads them through the real scans (SRC-1..8, FIL-18, RAS-5, ORC)."""
from __future__ import annotations

from pyspark.sql import functions as F

from movegrid.operators import tracks
from movegrid.plans import catch_queries as cq
from movegrid.plans import grid_queries as gq
from movegrid.plans import image_queries as iq
from movegrid.plans import pipeline
from movegrid.plans import track_queries as tq
from movegrid.plans.common import rounded
from movegrid.session import work_folder
from movegrid.sources import catch as catch_src
from movegrid.sources import files, standins

FIRST_IDS = 20


def write_inputs(spark, sf_dir) -> pipeline.Config:
    """The inputs of a run as files in the shared folder, and the configuration that names them."""
    folder = work_folder(spark, "run")
    csv = lambda df, name: df.write.option("header", True).csv(f"{folder}/{name}")
    date = F.date_format("Date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date")
    csv(standins.track_points(spark, sf_dir).select("id", date, "Latitude", "Longitude"), "tracks")
    published = lambda df, names: df.select(*[F.col(plain).alias(name) for name, plain in names.items()])
    csv(published(standins.catch_facts(spark, sf_dir), catch_src.FACT_COLUMNS), "capture")
    csv(published(standins.species_dim(spark, sf_dir), catch_src.SPECIES_COLUMNS), "species")
    csv(published(standins.area_dim(spark, sf_dir), catch_src.AREA_COLUMNS), "areas")
    n = F.col("row_order")
    stem = F.element_at(F.array(*[F.lit(x) for x in standins.IMAGE_STEMS]), (n % len(standins.IMAGE_STEMS) + 1).cast("int"))
    named = standins.whole_images(spark, sf_dir).select(F.concat(stem, F.lit("_"), n.cast("string"), F.lit(".png")).alias("name"), "content")
    files.write_bytes(named, f"{folder}/images").write.parquet(f"{folder}/images-written")
    return pipeline.Config(
        tracks_csv=f"{folder}/tracks", grid_path=gq.netcdf_files(spark, sf_dir), grid_format="netcdf", capture_csv=f"{folder}/capture",
        species_csv=f"{folder}/species", areas_csv=f"{folder}/areas", image_dir=f"{folder}/images", target_area=None, resolution=cq.RESOLUTION,
        train_model=False, work_dir=f"{folder}/work")


def run(spark, sf_dir):
    return pipeline.run(spark, write_inputs(spark, sf_dir))


def q_run_sources(spark, sf_dir):
    """SRC-8/FIL-18: the inputs found before the run."""
    return run(spark, sf_dir)["sources"].select("source", "required", "present")


def q_run_track_report(spark, sf_dir):
    return run(spark, sf_dir)["track_summary_report"]


def q_run_raster_grid(spark, sf_dir):
    """RAS-4/5 of catch files."""
    return rounded(run(spark, sf_dir)["raster_grid"], {"catch": 8})


def q_run_grid_daily(spark, sf_dir):
    """AGG-19 of NetCDF files."""
    return rounded(run(spark, sf_dir)["grid_daily_abundance"], {"acartia_abundance": 10})


def q_run_images(spark, sf_dir):
    """SRC-7: the catalogue of the image files that can be read."""
    return run(spark, sf_dir)["image_catalog"].select("name", "category", "filename", "width", "height", "mode", "size_bytes")


def q_track_first_ids(spark, sf_dir):
    """ORD-4, FIL-16, JN-10: the clean fixes of the first ids in order, for a drawing that shows only some."""
    cl = tq.cleaned(spark, sf_dir)
    return tracks.of_ids(cl, tracks.first_ids(cl, FIRST_IDS)).select("id", "Date", "row_order", "Latitude", "Longitude")


QUERIES = {
    "run_sources": q_run_sources,
    "run_track_report": q_run_track_report,
    "run_raster_grid": q_run_raster_grid,
    "run_grid_daily": q_run_grid_daily,
    "run_images": q_run_images,
    "track_first_ids": q_track_first_ids,
}

_stem = f"[{', '.join(repr(x) for x in standins.IMAGE_STEMS)}][n % {len(standins.IMAGE_STEMS)} + 1]"
ORACLE = {
    "run_sources": """
SELECT 'tracks' AS source, true AS required, true AS present
UNION ALL SELECT 'grid', false, (SELECT count(*) > 0 FROM embeddings)
UNION ALL SELECT 'catch', false, (SELECT count(*) > 0 FROM lineitem) AND (SELECT count(*) > 0 FROM part) AND (SELECT count(*) > 0 FROM nation)
UNION ALL SELECT 'images', false, (SELECT count(*) > 0 FROM pages)""",
    "run_track_report": tq.ORACLE["track_summary_report"],
    "run_raster_grid": cq.ORACLE["raster_grid"],
    "run_grid_daily": "SELECT time, round(avg(acartia_abundance), 10) AS acartia_abundance FROM (" + gq.ORACLE["grid_netcdf"] + ") GROUP BY time",
    "run_images": iq._WHOLE + f"""
, nm AS (SELECT *, {_stem} || '_' || CAST(n AS VARCHAR) AS name FROM s WHERE (n % 6 + 6) % 6 IN (0, 3))
SELECT name, CASE WHEN {iq._species} THEN 'plankton_species' WHEN {iq._env} THEN 'environmental' ELSE 'other' END AS category, name || '.png' AS filename,
       CAST(n % 640 + 1 AS BIGINT) AS width, CAST(n % 480 + 1 AS BIGINT) AS height, 'RGB' AS mode, CAST(size AS BIGINT) AS size_bytes
FROM nm""",
    "track_first_ids": tq._sql(f"""
SELECT id, "Date", row_order, Latitude, Longitude FROM cl WHERE id IN (SELECT DISTINCT id FROM cl ORDER BY id LIMIT {FIRST_IDS})"""),
}
