"""End-to-end orchestration over domain files (ORC): lazy DataFrames per output.

``run`` checks the inputs and builds every output as a lazy DataFrame; ``export`` writes them.
Where ``Config.work_dir`` names a shared folder, the processed fixes and the grid, which many
outputs read, are written there once as Parquet and read back, so that later readers keep column
pruning and filters.  Jobs run only for the input checks, those writes, exact samples and medians
and the model fit (an estimator is an action by nature).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from movegrid.functions import resolve
from movegrid.functions.scalars import attach_one_row
from movegrid.operators import catch, features, grids, images, model, profiles, raster, sinks, tracks, versions
from movegrid.params import ELASMOBRANCH_KEYWORDS, NORTH_SEA_AREA
from movegrid.plans import report
from movegrid.sources import catch as catch_src
from movegrid.sources import files as file_src
from movegrid.sources import grids as grid_src
from movegrid.sources import images as image_src
from movegrid.sources import netcdf
from movegrid.sources import tracks as track_src
from movegrid.sources import validate
from movegrid.sources.text_tables import scan_text

# Partition columns of the large outputs (partition pruning for downstream readers)
PARTITION_BY = {"tracks_processed": ["year", "month"], "catch_joined": ["period"], "raster_cells": ["period"]}
KEYS = ("lat_key", "lon_key", "lat_bin", "lon_bin")


@dataclass(frozen=True)
class Config:
    tracks_csv: str
    grid_path: str | None = None            # NetCDF files, array-encoded slabs (any Spark format), or None
    grid_format: str = "parquet"            # or "netcdf"
    grid_variables: tuple[str, ...] | None = None   # default: those found in the slabs by name
    use_sample_grid: bool = False           # explicit choice, no silent fallback (D22)
    capture_csv: str | None = None
    species_csv: str | None = None
    areas_csv: str | None = None
    image_dir: str | None = None
    target_area: int | None = NORTH_SEA_AREA
    resolution: float = 1.0
    model_type: str = "random_forest"
    test_size: float = 0.2                  # forwarded (D21)
    parity: bool = False
    chunk_days: int | None = tracks.DEFAULT_CHUNK_DAYS
    keywords: tuple[str, ...] = tuple(ELASMOBRANCH_KEYWORDS)
    train_model: bool = True
    cv_folds: int = 5                       # refits of the cross-validation that follows every training
    work_dir: str | None = None             # shared folder for the processed fixes and the grid
    sample_every: int = 3                   # thinning of the sampled tracks


def _kept(df: DataFrame, cfg: Config, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once under ``cfg.work_dir`` and read back; as it is where none is given."""
    if cfg.work_dir is None:
        return df
    path = sinks.write_table(df, f"{cfg.work_dir}/{name}", partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def run(spark: SparkSession, cfg: Config) -> dict[str, DataFrame | object]:
    out: dict[str, DataFrame | object] = {"sources": validate.validate(spark, validate.Inputs(
        cfg.tracks_csv, cfg.grid_path, cfg.capture_csv, cfg.species_csv, cfg.areas_csv, cfg.image_dir))}
    # tracks
    raw = track_src.read_track_csv(spark, cfg.tracks_csv)
    processed = _kept(tracks.process(raw, chunk_days=cfg.chunk_days), cfg, "tracks_all", ["year", "month"])
    clean = tracks.clean(processed)
    chunks = tracks.chunked(clean, chunk_days=tracks.DEFAULT_CHUNK_DAYS)     # heavy slices are looked for once for all positions
    summary_report = tracks.summary_report(clean)
    out.update({
        "track_overview": tracks.overview(raw),
        "track_date_text": track_src.raw_profile(spark, cfg.tracks_csv),
        "tracks_processed": clean,
        "track_clean_accounting": tracks.clean_accounting(processed),
        "track_totals": tracks.totals(clean),
        "track_summary": tracks.summary(clean),
        "track_summary_report": summary_report,
        "track_sampled": tracks.sampled_per_id(chunks, cfg.sample_every).select("id", "Date", "Latitude", "Longitude"),
        "track_endpoints": tracks.endpoints(clean),
        "track_polylines": tracks.polylines(chunks),
        "track_density": profiles.density(clean),
        "movement_by_date": profiles.movement_by_date(clean),
        "records_by_month": profiles.records_by_month(clean),
        "monthly_patterns": profiles.monthly_patterns(clean),
        "distance_histogram": profiles.histogram(summary_report, "distance_sum", 20, "n_ids"),
        "map_center": profiles.map_center(clean),
    })
    # grid
    grid = None
    if cfg.grid_path:
        if cfg.grid_format == "netcdf":
            slabs = netcdf.read_slabs(spark, cfg.grid_path)
            out["grid_status"] = netcdf.status(netcdf.plan(file_src.listing(spark, cfg.grid_path, file_src.GRID_PATTERN)))
        else:
            slabs = grid_src.read_array_slabs(spark, cfg.grid_path, cfg.grid_format)
            out["grid_status"] = grid_src.slab_status(spark, cfg.grid_path, cfg.grid_format)
        variables = list(cfg.grid_variables or grid_src.slab_variables(slabs))
        grid = grid_src.slabs_to_wide(slabs, variables) if variables else None
    elif cfg.use_sample_grid:
        grid = grid_src.sample_grid(spark)
    if grid is not None:
        grid = _kept(grid, cfg, "grid_all")
        out.update({
            "grid": grid,
            "grid_profile": grids.profile(grid),
            "grid_plankton_summary": grids.plankton_summary(grid, cfg.parity),
            "grid_env_summary": grids.environment_summary(grid, cfg.parity),
        })
        if resolve.abundance_columns(grid.columns):
            out["grid_daily_abundance"] = grids.mean_by_time(grid)
            out["grid_positive_scaled"] = grids.positive_scaled(grid)
    # catch
    if cfg.capture_csv and cfg.species_csv and cfg.areas_csv:
        facts = catch_src.read_capture(spark, cfg.capture_csv)
        species = catch.match_species(catch_src.read_species(spark, cfg.species_csv), list(cfg.keywords))
        joined = catch.enrich(facts, species, catch_src.read_areas(spark, cfg.areas_csv))
        totals = catch.area_period(joined, cfg.target_area)
        bounds = raster.area_bounds(spark)
        g = raster.grid(totals, bounds, cfg.resolution)
        out.update({
            "catch_rejects": catch_src.capture_rejects(scan_text(spark, cfg.capture_csv)),
            "catch_joined": joined,
            "catch_summary": catch.summary(joined),
            "top_species": catch.top_species(joined, NORTH_SEA_AREA),
            "raster_cells": raster.cells(totals, bounds, cfg.resolution),
            "raster_grid": g,
            "raster_stats": raster.stats(g, cfg.resolution),
            "raster_wide": raster.wide(g, cfg.resolution),
        })
    # images
    if cfg.image_dir:
        files = image_src.read_png_files(spark, cfg.image_dir)
        if files is not None:
            cat = images.catalog(files, whole=True)
            out.update({"image_catalog": cat, "image_integrity": images.integrity(files), "image_counts": images.counts(cat), "image_gallery": images.gallery(cat),
                        "image_overlays": images.overlays(cat)})
    # aligned features, correlation and model
    binned = features.bin_join(clean, grid)
    out["binned_features"] = binned
    aligned = features.bin_join(clean, grid, impute=None)
    out["aligned_correlation"] = features.correlation(aligned, [c for c in aligned.columns if c not in KEYS])
    out["feature_encodings"] = features.encodings(clean)
    if cfg.train_model:
        tm = model.train(binned, cfg.model_type, test_size=cfg.test_size, parity=cfg.parity)
        out["model"] = tm
        folds = model.cross_validate(tm, cfg.cv_folds)
        cv = model.cv_summary(folds).select(F.col("n_folds").alias("cv_folds"), F.col("r2_mean").alias("cv_r2_mean"), F.col("r2_two_std").alias("cv_r2_two_std"))
        out["model_summary"] = attach_one_row(tm.summary(), cv)
        out["model_importance"] = tm.importance()
        if cfg.model_type == "random_forest":
            out["model_cv"] = folds
            out["model_predictions"] = tm.predict(tm.test).select(*KEYS, "label", "prediction", "residual")
    # report
    sections = [report.track_section(out["track_overview"], report.clean_overview(clean))]
    if grid is not None:
        sections.append(report.grid_section(out["grid_profile"]))
    if "catch_summary" in out:
        sections.append(report.catch_section(out["catch_summary"]))
    if "model_summary" in out:
        sections.append(report.model_section(out["model_summary"]))
    out["report"] = report.assemble(sections)
    return out


def export(results: dict, output_dir: str) -> dict[str, str]:
    """Write every table output (Parquet), the wide raster (CSV) and the report (text) as one new version below ``output_dir``
    (``versions``): readers see all of them or the version before.  Returns the paths written."""
    tables, paths = {n: df for n, df in results.items() if isinstance(df, DataFrame)}, {}
    if not tables:
        raise ValueError("no processed data to export")
    with versions.Export(next(iter(tables.values())).sparkSession, output_dir) as out:
        for name, df in tables.items():
            if name == "report":
                paths[name] = sinks.write_report(df, out.folder(name, "text"))
            elif name == "raster_wide":
                paths[name] = sinks.write_wide_csv(df, out.folder(name, "csv"))
            else:
                paths[name] = sinks.write_table(df, out.folder(name), partition_by=PARTITION_BY.get(name))
    return paths
