"""Catch and raster queries over the lineitem/orders/supplier/part/nation stand-ins, and SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from movegrid.operators import catch, keywords, raster
from movegrid.params import AREA_BOUNDS, ELASMOBRANCH_KEYWORDS, SPECIES_SEARCH_COLUMNS
from movegrid.plans.common import rounded
from movegrid.sources.catch import capture_rejects, parse_capture
from movegrid.sources.standins import NATION_AREA_CODES, area_dim, catch_facts, catch_text, keyword_table, species_dim

RESOLUTION = 5.0


def matched(spark, sf_dir):
    return catch.match_species(species_dim(spark, sf_dir))


def joined(spark, sf_dir):
    return catch.enrich(catch_facts(spark, sf_dir), matched(spark, sf_dir), area_dim(spark, sf_dir))


def area_period_totals(spark, sf_dir):
    return catch.area_period(joined(spark, sf_dir))


def q_species_match(spark, sf_dir):
    return matched(spark, sf_dir)


def q_species_keyword_hits(spark, sf_dir):
    """FIL-7 with keywords as a table: which keyword is in the names of which species."""
    found = keywords.hits(species_dim(spark, sf_dir), "species_code", SPECIES_SEARCH_COLUMNS, keyword_table(spark, sf_dir))
    return found.select(F.col("id").alias("species_code"), "keyword")


def q_species_codes(spark, sf_dir):
    """ORD-6: the matched species codes in order."""
    return matched(spark, sf_dir).select("species_code").orderBy("species_code")


def q_catch_parsed(spark, sf_dir):
    """SRC-2: text rows under the published names through the reader's parse."""
    return parse_capture(catch_text(spark, sf_dir))


def q_catch_rejects(spark, sf_dir):
    """SRC-2: fields that could not be read, with counts."""
    return capture_rejects(catch_text(spark, sf_dir))


def q_catch_joined(spark, sf_dir):
    return joined(spark, sf_dir)


def q_catch_totals(spark, sf_dir):
    return catch.totals(joined(spark, sf_dir))


def q_catch_summary(spark, sf_dir):
    return catch.summary(joined(spark, sf_dir))


def q_catch_area_period(spark, sf_dir):
    return area_period_totals(spark, sf_dir)


def q_catch_region(spark, sf_dir):
    return catch.totals(catch.in_area(joined(spark, sf_dir), 27))


def q_top_species(spark, sf_dir):
    return catch.top_species(joined(spark, sf_dir), 27, 10)


def q_raster_cells(spark, sf_dir):
    return raster.cells(area_period_totals(spark, sf_dir), raster.area_bounds(spark), RESOLUTION)


def q_raster_grid(spark, sf_dir):
    g = raster.grid(area_period_totals(spark, sf_dir), raster.area_bounds(spark), RESOLUTION)
    return rounded(g, {"catch": 8})


def q_raster_stats(spark, sf_dir):
    g = raster.grid(area_period_totals(spark, sf_dir), raster.area_bounds(spark), RESOLUTION)
    return rounded(raster.stats(g, RESOLUTION), {"total_distributed": 6})


def q_raster_wide(spark, sf_dir):
    g = raster.grid(area_period_totals(spark, sf_dir), raster.area_bounds(spark), RESOLUTION)
    w = raster.wide(g, RESOLUTION)
    return w.select("lat", *[F.round(F.col(f"`{c}`"), 8).alias(c) for c in w.columns if c != "lat"])


def q_raster_unallocated(spark, sf_dir):
    return raster.unallocated(area_period_totals(spark, sf_dir), raster.area_bounds(spark), RESOLUTION)


QUERIES = {
    "species_match": q_species_match,
    "species_keyword_hits": q_species_keyword_hits,
    "species_codes": q_species_codes,
    "catch_parsed": q_catch_parsed,
    "catch_rejects": q_catch_rejects,
    "catch_joined": q_catch_joined,
    "catch_totals": q_catch_totals,
    "catch_summary": q_catch_summary,
    "catch_area_period": q_catch_area_period,
    "catch_region": q_catch_region,
    "top_species": q_top_species,
    "raster_cells": q_raster_cells,
    "raster_grid": q_raster_grid,
    "raster_stats": q_raster_stats,
    "raster_wide": q_raster_wide,
    "raster_unallocated": q_raster_unallocated,
}

# ---------------------------------------------------------------------------------------------
_codes = ", ".join(str(c) for c in NATION_AREA_CODES)
_pattern = "(" + "|".join(ELASMOBRANCH_KEYWORDS) + ")"
_match = " OR ".join(f"regexp_matches(coalesce({c}, ''), '{_pattern}', 'i')"
                     for c in ["name_en", "name_fr", "name_es", "scientific_name", "group_en"])
_bounds = ",\n    ".join(
    f"({c}, '{n}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({d} AS DOUBLE), CAST({e} AS DOUBLE))"
    for c, n, a, b, d, e in AREA_BOUNDS)
N_LAT = raster.axis_length(180.0, RESOLUTION)
N_LON = raster.axis_length(360.0, RESOLUTION)
R = RESOLUTION

CATCH_CTES = f"""
cf AS (
  SELECT l.l_partkey AS species_code,
         CAST(CASE WHEN s.s_nationkey <= 20 THEN [{_codes}][s.s_nationkey + 1] ELSE s.s_nationkey - 20 END AS INTEGER)
           AS area_code,
         CAST(year(o.o_orderdate) AS INTEGER) AS period, l.l_quantity AS value,
         l.l_orderkey * 100000 + l.l_linenumber * 10000 + l.l_suppkey AS row_order
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
sp AS (
  SELECT p_partkey AS species_code, CASE WHEN p_partkey % 13 = 0 THEN 'Blue SHARK ' ELSE '' END || p_name AS name_en,
         CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 13 = 6 THEN 'CHIMÈRE ' ELSE '' END || p_brand END AS name_fr,
         CASE WHEN p_partkey % 13 = 4 THEN 'TIBURÓN ' ELSE '' END || p_brand AS name_es,
         CASE WHEN p_partkey % 13 = 2 THEN 'Полярная АКУЛА ' ELSE '' END || p_type AS scientific_name,
         CASE WHEN p_partkey % 13 = 8 THEN '鲨鱼 ' ELSE '' END || 'GROUP ' || CAST(p_size % 10 AS VARCHAR) AS group_en
  FROM part),
ad AS (
  SELECT CAST(CASE WHEN n_nationkey <= 20 THEN [{_codes}][n_nationkey + 1] ELSE n_nationkey - 20 END AS INTEGER) AS code,
         n_name AS area_name, r_name AS ocean_group,
         CASE WHEN n_nationkey <= 20 THEN 'Marine areas' WHEN n_nationkey <= 23 THEN 'Inland waters' END
           AS inland_marine_group
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
ms AS (SELECT * FROM sp WHERE {_match}),
cj AS (
  SELECT cf.area_code, cf.species_code, cf.period, cf.value, cf.row_order, ms.name_en, ms.scientific_name, ms.group_en,
         ad.area_name, ad.ocean_group, ad.inland_marine_group
  FROM cf JOIN ms ON cf.species_code = ms.species_code LEFT JOIN ad ON cf.area_code = ad.code
  WHERE ad.inland_marine_group IS NOT NULL),
ap AS (
  SELECT area_code, period, coalesce(sum(value), 0) AS value,
         arg_min(name_en, (row_order, species_code)) FILTER (WHERE name_en IS NOT NULL) AS name_en,
         arg_min(scientific_name, (row_order, species_code)) FILTER (WHERE scientific_name IS NOT NULL) AS scientific_name
  FROM cj GROUP BY area_code, period),
bd AS (
  SELECT * FROM (VALUES
    {_bounds}) t(code, name, lat_min, lat_max, lon_min, lon_max)),
ix AS (
  SELECT bd.*,
         GREATEST(CAST(ceil((lat_min + 90) / {R} - 1e-9) AS INTEGER), 0) AS la,
         LEAST(CAST(floor((lat_max + 90) / {R} + 1e-9) AS INTEGER), {N_LAT - 1}) AS lb,
         GREATEST(CAST(ceil((lon_min + 180) / {R} - 1e-9) AS INTEGER), 0) AS oa,
         LEAST(CAST(floor((lon_max + 180) / {R} + 1e-9) AS INTEGER), {N_LON - 1}) AS ob
  FROM bd),
ixl AS (
  SELECT code, name, CAST(generate_series(la, lb) AS INTEGER[]) AS lat_list,
         CAST(CASE WHEN lon_min > lon_max THEN list_concat(generate_series(oa, {N_LON - 1}), generate_series(0, ob))
              ELSE generate_series(oa, ob) END AS INTEGER[]) AS lon_list
  FROM ix),
alloc AS (
  SELECT t.*, ixl.name AS area_name, lat_list, lon_list, len(lat_list) * len(lon_list) AS n_cells
  FROM (SELECT area_code, period, value FROM ap) t JOIN ixl ON t.area_code = ixl.code),
cells AS (
  SELECT area_code, period, area_name, lat_idx, unnest(lon_list) AS lon_idx, value / n_cells AS catch
  FROM (SELECT *, unnest(lat_list) AS lat_idx FROM alloc WHERE n_cells > 0)),
grid AS (
  SELECT lat_idx, lon_idx, CAST(-90 AS DOUBLE) + lat_idx * CAST({R} AS DOUBLE) AS lat, CAST(-180 AS DOUBLE) + lon_idx * CAST({R} AS DOUBLE) AS lon, sum(catch) AS catch
  FROM (
    SELECT lat_idx, unnest(lon_list) AS lon_idx, value / n_cells AS catch
    FROM (SELECT *, unnest(lat_list) AS lat_idx FROM (
      SELECT t.area_code, ixl.name AS area_name, t.value, lat_list, lon_list, len(lat_list) * len(lon_list) AS n_cells
      FROM (SELECT area_code, sum(value) AS value FROM ap GROUP BY area_code) t JOIN ixl ON t.area_code = ixl.code)
      WHERE n_cells > 0))
  GROUP BY lat_idx, lon_idx)
"""


def _sql(body: str) -> str:
    return "WITH " + CATCH_CTES.strip() + "\n" + body


_wide_cols = ",\n  ".join(
    f"round(coalesce(sum(CASE WHEN g.lon_idx = {i} THEN g.catch END), 0), 8) AS \"{raster.lon_label(i, R)}\""
    for i in range(N_LON))

ORACLE = {
    "species_match": _sql("SELECT * FROM ms"),
    "species_keyword_hits": _sql(f"""
, kw AS (SELECT unnest({ELASMOBRANCH_KEYWORDS}) AS keyword UNION SELECT 'Brand#' || CAST(c_custkey AS VARCHAR) FROM customer)
SELECT DISTINCT species_code, keyword
FROM (SELECT species_code, unnest([{", ".join(SPECIES_SEARCH_COLUMNS)}]) AS t FROM sp) JOIN kw ON contains(lower(t), lower(keyword))"""),
    "species_codes": _sql("SELECT species_code FROM ms ORDER BY species_code"),
    "catch_parsed": _sql("""
SELECT CAST(species_code AS VARCHAR) AS species_code, CASE WHEN row_order % 3 = 0 OR row_order % 50 <> 1 THEN area_code END AS area_code,
       period, CASE WHEN row_order % 20 <> 0 AND row_order % 21 <> 0 THEN value END AS value, row_order
FROM cf"""),
    "catch_rejects": _sql("""
SELECT 'area_code' AS column, '27.5' AS text, count(*) AS n_rows FROM cf WHERE row_order % 3 <> 0 AND row_order % 50 = 1 HAVING count(*) > 0
UNION ALL SELECT 'value', 'n/a', count(*) FROM cf WHERE row_order % 20 <> 0 AND row_order % 21 = 0 HAVING count(*) > 0"""),
    "catch_joined": _sql("SELECT * FROM cj"),
    "catch_totals": _sql("""
SELECT count(*) AS n_rows, min(period) AS period_min, max(period) AS period_max, coalesce(sum(value), 0) AS total_value
FROM cj"""),
    "catch_summary": _sql("""
SELECT count(DISTINCT species_code) AS unique_species, count(DISTINCT area_code) AS unique_areas,
       coalesce(sum(value), 0) AS total_catch, min(period) AS period_min, max(period) AS period_max
FROM cj"""),
    "catch_area_period": _sql("SELECT * FROM ap"),
    "catch_region": _sql("""
SELECT count(*) AS n_rows, min(period) AS period_min, max(period) AS period_max, coalesce(sum(value), 0) AS total_value
FROM cj WHERE area_code = 27"""),
    "top_species": _sql("""
SELECT species_code, name_en, sum(value) AS value FROM cj WHERE area_code = 27
GROUP BY species_code, name_en ORDER BY value DESC, species_code LIMIT 10"""),
    "raster_cells": _sql(f"""
SELECT lat_idx, lon_idx, CAST(-90 AS DOUBLE) + lat_idx * CAST({R} AS DOUBLE) AS lat, CAST(-180 AS DOUBLE) + lon_idx * CAST({R} AS DOUBLE) AS lon, catch, area_code, area_name, period
FROM cells"""),
    "raster_grid": _sql("SELECT lat_idx, lon_idx, lat, lon, round(catch, 8) AS catch FROM grid"),
    "raster_stats": _sql(f"""
SELECT {N_LAT} AS n_lat, {N_LON} AS n_lon, count(*) FILTER (WHERE catch <> 0) AS nonzero_cells,
       round(coalesce(sum(catch), 0), 6) AS total_distributed
FROM grid"""),
    "raster_wide": _sql(f"""
SELECT printf('lat_%.1f', CAST(-90 AS DOUBLE) + l.lat_idx * CAST({R} AS DOUBLE)) AS lat,
  {_wide_cols}
FROM (SELECT CAST(range AS INTEGER) AS lat_idx FROM range(0, {N_LAT})) l LEFT JOIN grid g ON g.lat_idx = l.lat_idx
GROUP BY l.lat_idx"""),
    "raster_unallocated": _sql("""
SELECT ap.area_code, ap.period, ap.value FROM ap LEFT JOIN ixl ON ap.area_code = ixl.code
WHERE ixl.code IS NULL OR len(ixl.lat_list) * len(ixl.lon_list) = 0"""),
}
