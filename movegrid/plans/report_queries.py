"""Source and analysis report queries over the stand-ins, and SQL twins."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from movegrid.functions.scalars import attach_one_row
from movegrid.operators import catch as catch_ops
from movegrid.operators import grids, sinks, tracks, versions
from movegrid.plans import catch_queries as cq
from movegrid.plans import track_queries as tq
from movegrid.plans.report import assemble, catch_section, clean_overview, grid_section, track_section
from movegrid.session import work_folder
from movegrid.sources import standins


def q_source_report(spark, sf_dir):
    """SRC-8/FIL-18: each domain source with its requirement flag, presence and row count."""
    sources = [
        ("tracks", True, standins.track_points(spark, sf_dir)),
        ("grid", False, standins.grid_points(spark, sf_dir)),
        ("catch_facts", False, standins.catch_facts(spark, sf_dir)),
        ("species", False, standins.species_dim(spark, sf_dir)),
        ("areas", False, standins.area_dim(spark, sf_dir)),
        ("images", False, standins.image_files(spark, sf_dir)),
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("source"), F.lit(req).alias("required"), (F.col("n_rows") > 0).alias("present"), "n_rows")
        for name, req, df in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_analysis_report(spark, sf_dir):
    raw = tracks.overview(standins.track_points(spark, sf_dir))
    cl = tq.cleaned(spark, sf_dir)
    t = track_section(raw, clean_overview(cl))
    g = grid_section(grids.profile(standins.grid_points(spark, sf_dir).drop("row_order", "row_tiebreak")))
    c = catch_section(catch_ops.summary(cq.joined(spark, sf_dir)))
    return assemble([t, g, c]).select("section", "metric", "value")


def q_export_versions(spark, sf_dir):
    """SNK-1/3: the tracks' days are exported, then all exported anew; the last version is read back, beside the versions there are."""
    root = work_folder(spark, "export")
    days = tq.q_movement_by_day(spark, sf_dir)
    for some in (days.where(F.dayofmonth("Date") <= 10), days):
        with versions.Export(spark, root) as out:
            sinks.write_table(some, out.folder("movement_by_day"))
    n = versions.history(spark, root).agg(F.max("version").alias("version"), F.count(F.lit(1)).alias("n_versions"))
    return attach_one_row(versions.read(spark, root, "movement_by_day"), n)


QUERIES = {
    "export_versions": q_export_versions,
    "source_report": q_source_report,
    "analysis_report": q_analysis_report,
}

from movegrid.plans.catch_queries import CATCH_CTES  # noqa: E402
from movegrid.plans.grid_queries import GRID_CTES  # noqa: E402
from movegrid.plans.track_queries import TRACK_CTES  # noqa: E402

_ALL = "WITH " + TRACK_CTES.strip() + ",\n" + GRID_CTES.strip() + ",\n" + CATCH_CTES.strip() + "\n"

ORACLE = {
    "export_versions": _ALL + """
SELECT date_trunc('day', "Date") AS "Date", round(avg(distance), 6) AS avg_distance, round(avg(speed), 6) AS avg_speed,
       round(avg(Latitude), 10) AS avg_lat, round(avg(Longitude), 10) AS avg_lon, CAST(2 AS BIGINT) AS version, CAST(2 AS BIGINT) AS n_versions
FROM cl GROUP BY 1""",
    "source_report": _ALL + """
SELECT 'tracks' AS source, true AS required, count(*) > 0 AS present, count(*) AS n_rows FROM tp
UNION ALL SELECT 'grid', false, count(*) > 0, count(*) FROM gp
UNION ALL SELECT 'catch_facts', false, count(*) > 0, count(*) FROM cf
UNION ALL SELECT 'species', false, count(*) > 0, count(*) FROM sp
UNION ALL SELECT 'areas', false, count(*) > 0, count(*) FROM ad
UNION ALL SELECT 'images', false, count(*) > 0, count(*) FROM pages""",
    "analysis_report": _ALL + """
, raw AS (SELECT count(*) AS n, count(DISTINCT id) AS ids, min("Date") AS dmin, max("Date") AS dmax FROM tp),
ct AS (SELECT count(*) AS n, coalesce(sum(distance), 0) AS dist, avg(speed) AS spd,
       min(Latitude) AS la, max(Latitude) AS lb, min(Longitude) AS oa, max(Longitude) AS ob FROM cl),
cs AS (SELECT count(DISTINCT species_code) AS sp, count(DISTINCT area_code) AS ar, coalesce(sum(value), 0) AS tot,
              min(period) AS p0, max(period) AS p1 FROM cj),
gq AS (SELECT count(*) AS n, count(DISTINCT file_source) AS f FROM gp)
SELECT 'tracks' AS section, 'raw_records' AS metric, format('{:,}', n) AS value FROM raw
UNION ALL SELECT 'tracks', 'raw_individuals', CAST(ids AS VARCHAR) FROM raw
UNION ALL SELECT 'tracks', 'date_from', strftime(dmin, '%Y-%m-%d') FROM raw
UNION ALL SELECT 'tracks', 'date_to', strftime(dmax, '%Y-%m-%d') FROM raw
UNION ALL SELECT 'tracks', 'clean_records', format('{:,}', n) FROM ct
UNION ALL SELECT 'tracks', 'clean_latitude', printf('%.2f to %.2f', la, lb) FROM ct
UNION ALL SELECT 'tracks', 'clean_longitude', printf('%.2f to %.2f', oa, ob) FROM ct
UNION ALL SELECT 'tracks', 'clean_total_distance', printf('%.2f', dist) FROM ct
UNION ALL SELECT 'tracks', 'clean_mean_speed', printf('%.4f', spd) FROM ct
UNION ALL SELECT 'grid', 'records', format('{:,}', n) FROM gq
UNION ALL SELECT 'grid', 'files', CAST(f AS VARCHAR) FROM gq
UNION ALL SELECT 'grid', 'abundance_variables', '3'
UNION ALL SELECT 'grid', 'environmental_variables', '2'
UNION ALL SELECT 'catch', 'species', CAST(sp AS VARCHAR) FROM cs
UNION ALL SELECT 'catch', 'areas', CAST(ar AS VARCHAR) FROM cs
UNION ALL SELECT 'catch', 'total_catch', printf('%.2f', tot) FROM cs
UNION ALL SELECT 'catch', 'period_from', CAST(p0 AS VARCHAR) FROM cs
UNION ALL SELECT 'catch', 'period_to', CAST(p1 AS VARCHAR) FROM cs""",
}
