"""Grid queries over the lineitem (long rows) and embeddings (array slabs) stand-ins, and SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from movegrid.functions import resolve
from movegrid.functions.ordering import arithmetic_hash
from movegrid.functions.temporal import with_grid_calendar
from movegrid.operators import grids, states
from movegrid.plans.common import rounded
from movegrid.session import work_folder
from movegrid.sources import files as file_src
from movegrid.sources import grids as grid_src
from movegrid.sources import netcdf
from movegrid.sources.standins import array_grid, grid_points, netcdf_grids

SLAB_VARIABLES = ["acartia_abundance", "temperature", "salinity"]
# Variables held by each stand-in "file" (files differ, so the union fills gaps with NULL)
FILE_VARIABLES = {
    "A": ["acartia_abundance", "calanus_abundance", "temperature"],
    "N": ["acartia_abundance", "metridia_abundance", "salinity"],
    "R": ["acartia_abundance", "calanus_abundance", "metridia_abundance", "temperature", "salinity"],
}
SAMPLE_SEED = 42
SAMPLE_SIZE = 1000


def sample_order():
    return [arithmetic_hash(F.col("row_order"), SAMPLE_SEED), F.col("row_order"), F.col("row_tiebreak")]


def grid_sample(spark, sf_dir):
    return grids.sample_rows(grid_points(spark, sf_dir), sample_order(), SAMPLE_SIZE)


def q_grid_long(spark, sf_dir):
    return grid_src.slabs_to_wide(array_grid(spark, sf_dir), SLAB_VARIABLES)


def q_grid_union(spark, sf_dir):
    files = {f"grid_{flag}.nc": ["time", "latitude", "longitude", "row_order", *variables] for flag, variables in FILE_VARIABLES.items()}
    return grids.union_selected(grid_points(spark, sf_dir), files)


def q_grid_temporal_features(spark, sf_dir):
    """PRJ-3 on a text time column, some of it no date."""
    gp = grid_points(spark, sf_dir)
    t = resolve.first_containing(gp.columns, "time")
    text = F.when(F.col("row_order") % 17 == 0, F.lit("no date")).otherwise(F.col(t).cast("string"))
    return with_grid_calendar(gp.withColumn(t, text), t).select("file_source", "time", "year", "month", "day_of_year", "season")


def q_grid_bounds(spark, sf_dir):
    return grids.bounds(grid_points(spark, sf_dir))


def q_grid_profile(spark, sf_dir):
    return grids.profile(grid_points(spark, sf_dir).drop("row_order", "row_tiebreak"))


def q_grid_variable_summary(spark, sf_dir):
    return rounded(grids.plankton_summary(grid_points(spark, sf_dir)), {"mean": 8, "std": 8})


def q_grid_env_summary(spark, sf_dir):
    return rounded(grids.environment_summary(grid_points(spark, sf_dir)), {"mean": 8, "std": 8})


def q_grid_daily_abundance(spark, sf_dir):
    d = grids.mean_by_time(grid_points(spark, sf_dir))
    return rounded(d, {c: 10 for c in d.columns if c != "time"})


def q_grid_sample(spark, sf_dir):
    return grid_sample(spark, sf_dir).drop("row_tiebreak")


def q_grid_positive_scaled(spark, sf_dir):
    return rounded(grids.positive_scaled(grid_points(spark, sf_dir)), {"scaled": 12})


def q_grid_daily_abundance_incremental(spark, sf_dir):
    """AGG-19 from the states of three grid files that came one by one."""
    gp, columns = grid_points(spark, sf_dir), ["acartia_abundance", "calanus_abundance", "metridia_abundance"]
    table = states.StateTable(spark, work_folder(spark, "states"))
    for flag in FILE_VARIABLES:
        states.add_grid(table, f"grid_{flag}.nc", gp.where(F.col("file_source") == f"grid_{flag}.nc"), columns)
    return rounded(states.mean_by_time(table, columns), dict.fromkeys(columns, 10))


def netcdf_files(spark, sf_dir):
    """The stand-in grid written as NetCDF files; the folder."""
    folder = work_folder(spark, "netcdf")
    netcdf.write_files(netcdf_grids(spark, sf_dir), folder).write.parquet(f"{folder}/written")
    return folder


def q_grid_netcdf(spark, sf_dir):
    """Slabs read by ranges of records out of NetCDF files, as wide rows."""
    return grid_src.slabs_to_wide(netcdf.read_slabs(spark, netcdf_files(spark, sf_dir), cells=256), SLAB_VARIABLES).drop("level")


def q_grid_netcdf_cells(spark, sf_dir):
    """Cells of two variables in a box and some weeks, out of the same files by the data source, filters pushed into it."""
    folder = netcdf_files(spark, sf_dir)
    netcdf.register(spark)
    cells = spark.read.format("netcdf").option("cells", 256).load(folder)
    inside = F.col("latitude").between(50.1, 50.3) & F.col("longitude").between(1.05, 1.2)
    days = (F.col("time") >= F.lit("2021-08-10").cast("timestamp_ntz")) & (F.col("time") < F.lit("2021-09-10").cast("timestamp_ntz"))
    return cells.where(F.col("variable").isin("temperature", "salinity") & inside & days).drop("level")


def q_grid_files(spark, sf_dir):
    """Length and readability of every NetCDF file that the recursive listing finds."""
    found = file_src.listing(spark, netcdf_files(spark, sf_dir), file_src.GRID_PATTERN)
    state = netcdf.status(netcdf.plan(found)).select(F.col("path").alias("at"), "status", "n_slabs")
    name = F.element_at(F.split("path", "/"), -1)
    return found.join(state, F.col("path") == F.col("at")).select(name.alias("file_source"), "length", "status", "n_slabs")


QUERIES = {
    "grid_long": q_grid_long,
    "grid_union": q_grid_union,
    "grid_temporal_features": q_grid_temporal_features,
    "grid_bounds": q_grid_bounds,
    "grid_profile": q_grid_profile,
    "grid_variable_summary": q_grid_variable_summary,
    "grid_env_summary": q_grid_env_summary,
    "grid_daily_abundance": q_grid_daily_abundance,
    "grid_sample": q_grid_sample,
    "grid_positive_scaled": q_grid_positive_scaled,
    "grid_daily_abundance_incremental": q_grid_daily_abundance_incremental,
    "grid_netcdf": q_grid_netcdf,
    "grid_netcdf_cells": q_grid_netcdf_cells,
    "grid_files": q_grid_files,
}

GRID_CTES = """
gp AS (
  SELECT l_shipdate AS time,
         CAST(50.0131 AS DOUBLE) + CAST(0.047 AS DOUBLE) * (l_partkey % 100) AS latitude,
         CAST(1.0037 AS DOUBLE) + CAST(0.04 AS DOUBLE) * (l_suppkey % 100) AS longitude,
         l_extendedprice / 100 AS acartia_abundance, l_quantity - 25 AS calanus_abundance,
         nullif(l_discount, 0) AS metridia_abundance, l_tax * 100 AS temperature, 35 - l_discount * 10 AS salinity,
         'grid_' || l_returnflag || '.nc' AS file_source,
         l_orderkey * 100000 + l_linenumber * 10000 + l_suppkey AS row_order, l_partkey AS row_tiebreak
  FROM lineitem),
gs AS (
  SELECT * FROM gp ORDER BY (CAST(row_order AS HUGEINT) * 2654435761 + 42) % 4294967296, row_order, row_tiebreak LIMIT 1000),
ag AS (
  SELECT 'emb_' || CAST(vec_id // 3 AS VARCHAR) || '.nc' AS file_source,
         ['acartia_abundance', 'temperature', 'salinity'][vec_id % 3 + 1] AS variable,
         CAST(DATE '2021-08-01' + CAST((vec_id // 3) % 61 AS INTEGER) AS TIMESTAMP) AS time,
         embedding
  FROM embeddings),
al AS (
  SELECT file_source, variable, time, CAST(v AS DOUBLE) AS value, pos - 1 AS pos
  FROM (SELECT file_source, variable, time, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM ag)),
ac AS (
  SELECT file_source, variable, time,
         CAST(50.0131 AS DOUBLE) + CAST(0.047 AS DOUBLE) * ((pos // 8) % 8) AS latitude,
         CAST(1.0037 AS DOUBLE) + CAST(0.04 AS DOUBLE) * (pos % 8) AS longitude,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value
  FROM al)
"""


def _sql(body: str) -> str:
    return "WITH " + GRID_CTES.strip() + "\n" + body


def _union_sql() -> str:
    parts = []
    for flag, variables in FILE_VARIABLES.items():
        cols = ", ".join(variables)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in ["time", "latitude", "longitude"] + variables)
        parts.append(f"SELECT time, latitude, longitude, file_source, {cols} FROM gp "
                     f"WHERE file_source = 'grid_{flag}.nc' AND {nn}")
    return "\nUNION ALL BY NAME\n".join(parts)


def _summary_sql(columns: list[str], with_count: bool) -> str:
    parts = []
    for c in columns:
        cnt = f", count({c}) AS count" if with_count else ""
        parts.append(f"SELECT '{c}' AS variable, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std, "
                     f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max{cnt} FROM gp")
    return "\nUNION ALL\n".join(parts)


_ABUND = ["acartia_abundance", "calanus_abundance", "metridia_abundance"]
_pos_parts = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, latitude, longitude, CAST({c} AS DOUBLE) AS value, "
    f"round({c} / (SELECT max({c}) FROM gp WHERE {c} > 0), 12) AS scaled FROM gp WHERE {c} > 0" for c in _ABUND)

ORACLE = {
    "grid_long": _sql("""
SELECT file_source, time, latitude, longitude,
       max(value) FILTER (WHERE variable = 'acartia_abundance') AS acartia_abundance,
       max(value) FILTER (WHERE variable = 'temperature') AS temperature,
       max(value) FILTER (WHERE variable = 'salinity') AS salinity
FROM ac GROUP BY file_source, time, latitude, longitude
HAVING count(*) FILTER (WHERE value IS NULL) = 0"""),
    "grid_netcdf": _sql("""
SELECT 'emb_' || CAST(CAST(regexp_extract(file_source, '[0-9]+') AS BIGINT) // 10 AS VARCHAR) || '.nc' AS file_source, time, latitude, longitude,
       max(value) FILTER (WHERE variable = 'acartia_abundance') AS acartia_abundance,
       max(value) FILTER (WHERE variable = 'temperature') AS temperature,
       max(value) FILTER (WHERE variable = 'salinity') AS salinity
FROM ac GROUP BY ac.file_source, time, latitude, longitude
HAVING count(value) = 3"""),
    "grid_netcdf_cells": _sql("""
SELECT 'emb_' || CAST(CAST(regexp_extract(f.file_source, '[0-9]+') AS BIGINT) // 10 AS VARCHAR) || '.nc' AS file_source, v.variable, f.time, f.latitude, f.longitude, ac.value
FROM (SELECT DISTINCT file_source, time, latitude, longitude FROM ac) f CROSS JOIN (VALUES ('temperature'), ('salinity')) v(variable)
LEFT JOIN ac USING (file_source, variable, time, latitude, longitude)
WHERE f.time >= TIMESTAMP '2021-08-10' AND f.time < TIMESTAMP '2021-09-10' AND f.latitude BETWEEN 50.1 AND 50.3 AND f.longitude BETWEEN 1.05 AND 1.2"""),
    "grid_files": _sql("""
SELECT 'emb_' || CAST(k AS VARCHAR) || '.nc' AS file_source, 420 + 8 * 16 + 8 * n * (3 * 64 + 1) AS length, 'ok' AS status,
       CAST(3 AS BIGINT) AS n_slabs
FROM (SELECT (vec_id // 3) // 10 AS k, count(DISTINCT vec_id // 3) AS n FROM embeddings GROUP BY 1)"""),
    "grid_union": _sql(_union_sql()),
    "grid_temporal_features": _sql("""
SELECT file_source, CAST(time AS TIMESTAMP) AS time, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
       CAST(dayofyear(time) AS INTEGER) AS day_of_year,
       CASE WHEN month(time) IN (12, 1, 2) THEN 'Winter' WHEN month(time) IN (3, 4, 5) THEN 'Spring'
            WHEN month(time) IN (6, 7, 8) THEN 'Summer' WHEN month(time) IN (9, 10, 11) THEN 'Autumn' END AS season
FROM (SELECT * REPLACE (CASE WHEN row_order % 17 <> 0 THEN time END AS time) FROM gp)"""),
    "grid_bounds": _sql("""
SELECT min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max FROM gp"""),
    "grid_profile": _sql("""
SELECT count(*) AS total_records, count(DISTINCT file_source) AS unique_files, 3 AS n_abundance_vars,
       2 AS n_env_vars, 9 AS n_columns FROM gp"""),
    "grid_variable_summary": _sql(_summary_sql(_ABUND, True)),
    "grid_env_summary": _sql(_summary_sql(["temperature", "salinity"], False)),
    "grid_daily_abundance": _sql("""
SELECT time, round(avg(acartia_abundance), 10) AS acartia_abundance,
       round(avg(calanus_abundance), 10) AS calanus_abundance, round(avg(metridia_abundance), 10) AS metridia_abundance
FROM gp GROUP BY time"""),
    "grid_daily_abundance_incremental": _sql("""
SELECT time, round(avg(acartia_abundance), 10) AS acartia_abundance,
       round(avg(calanus_abundance), 10) AS calanus_abundance, round(avg(metridia_abundance), 10) AS metridia_abundance
FROM gp GROUP BY time"""),
    "grid_sample": _sql("""
SELECT time, latitude, longitude, acartia_abundance, calanus_abundance, metridia_abundance, temperature, salinity,
       file_source, row_order FROM gs"""),
    "grid_positive_scaled": _sql(_pos_parts),
}
