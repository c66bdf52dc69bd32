"""Track queries over the ``events`` stand-in, and their SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from movegrid.operators import areas, profiles, pyramid, states, tracks
from movegrid.plans.common import rounded
from movegrid.session import work_folder
from movegrid.sources.standins import area_boxes, area_rings, track_points, track_text
from movegrid.sources import infer
from movegrid.sources.tracks import date_text_profile, parse_tracks


def processed(spark, sf_dir, chunk_days=tracks.DEFAULT_CHUNK_DAYS, cumulative=False):
    return tracks.process(track_points(spark, sf_dir), chunk_days=chunk_days, cumulative=cumulative)


def cleaned(spark, sf_dir, cumulative=False):
    return tracks.clean(processed(spark, sf_dir, cumulative=cumulative))


def q_track_overview(spark, sf_dir):
    return tracks.overview(track_points(spark, sf_dir))


def q_track_raw_profile(spark, sf_dir):
    """SRC-9: rows and min/max of the date text as it arrives (before parsing)."""
    return date_text_profile(track_text(spark, sf_dir))


def q_track_parsed(spark, sf_dir):
    """SRC-1: text rows in another column order, some unreadable, through the reader's parse."""
    df = parse_tracks(track_text(spark, sf_dir), strict=False)
    return df.select("id", "Date", "Latitude", "Longitude", "note", "row_order")


def q_track_temporal_features(spark, sf_dir):
    return tracks.with_calendar(track_points(spark, sf_dir)).select(
        "id", "Date", "row_order", "year", "month", "day_of_year", "week", "day_of_week", "hour", "season")


def q_track_movement_metrics(spark, sf_dir):
    df = processed(spark, sf_dir).select(
        "id", "Date", "row_order", "Latitude", "Longitude", "lat_diff", "lon_diff", "distance", "time_diff",
        "speed", "direction")
    return rounded(df, {"direction": 9})


def q_track_cumulative_distance(spark, sf_dir):
    df = processed(spark, sf_dir, cumulative=True).select("id", "Date", "row_order", "distance", "cumulative_distance")
    return rounded(df, {"cumulative_distance": 6})


def q_track_spatial_features(spark, sf_dir):
    df = processed(spark, sf_dir).select("id", "row_order", "center_lat", "center_lon", "dist_from_center",
                                         "lat_bin", "lon_bin")
    return rounded(df, {"center_lat": 10, "center_lon": 10, "dist_from_center": 8})


def q_track_clean(spark, sf_dir):
    df = cleaned(spark, sf_dir, cumulative=True).select("id", "Date", "row_order", "Latitude", "Longitude", "distance",
                                       "time_diff", "speed", "cumulative_distance", "lat_bin", "lon_bin", "season")
    return rounded(df, {"cumulative_distance": 6})


def q_track_clean_accounting(spark, sf_dir):
    return rounded(tracks.clean_accounting(processed(spark, sf_dir)), {"removed_pct": 6})


def q_track_totals(spark, sf_dir):
    return rounded(tracks.totals(cleaned(spark, sf_dir)),
                   {"total_distance": 6, "avg_speed": 6, "avg_distance_per_day": 6})


def q_track_summary(spark, sf_dir):
    return tracks.summary(cleaned(spark, sf_dir))


def q_track_summary_report(spark, sf_dir):
    return tracks.summary_report(cleaned(spark, sf_dir))


def q_track_sampled(spark, sf_dir):
    return tracks.sampled(cleaned(spark, sf_dir), 3).select("id", "Date", "row_order", "Latitude", "Longitude")


def q_track_sampled_per_id(spark, sf_dir):
    """WIN-5 per track (D28 option): every third fix of each id, no global order."""
    return tracks.sampled_per_id(cleaned(spark, sf_dir), 3).select("id", "Date", "row_order", "Latitude", "Longitude")


def q_track_clean_first(spark, sf_dir):
    """D1 option: steps are measured between fixes inside the box only."""
    df = tracks.process(track_points(spark, sf_dir), cumulative=False, clean_first=True)
    return df.select("id", "row_order", "distance", "time_diff", "speed")


def q_track_endpoints(spark, sf_dir):
    return tracks.endpoints(cleaned(spark, sf_dir))


def q_track_polylines(spark, sf_dir):
    return tracks.polylines(cleaned(spark, sf_dir))


def q_track_density(spark, sf_dir):
    return profiles.density(cleaned(spark, sf_dir))


def q_map_center(spark, sf_dir):
    return rounded(profiles.map_center(cleaned(spark, sf_dir)), {"center_lat": 8, "center_lon": 8})


def q_movement_by_date(spark, sf_dir):
    return rounded(profiles.movement_by_date(cleaned(spark, sf_dir)),
                   {"avg_distance": 6, "avg_speed": 6, "avg_lat": 10, "avg_lon": 10})


def q_movement_by_day(spark, sf_dir):
    """AGG-18 with ``grain='day'`` (D7 option): means per calendar day."""
    return rounded(profiles.movement_by_date(cleaned(spark, sf_dir), grain="day"),
                   {"avg_distance": 6, "avg_speed": 6, "avg_lat": 10, "avg_lon": 10})


def q_records_by_month(spark, sf_dir):
    return profiles.records_by_month(cleaned(spark, sf_dir))


def q_monthly_patterns(spark, sf_dir):
    return rounded(profiles.monthly_patterns(cleaned(spark, sf_dir)), {"avg_distance": 6, "avg_speed": 6})


def q_distance_histogram(spark, sf_dir):
    per_id = tracks.summary_report(cleaned(spark, sf_dir))
    return rounded(profiles.histogram(per_id, "distance_sum", 20, "n_ids"), {"bin_lo": 8, "bin_hi": 8})


def q_fixes_by_area(spark, sf_dir):
    """JN-5/FIL-13 over boxes of any number: fixes, ids and times in each."""
    return areas.count_in_areas(track_points(spark, sf_dir), area_boxes(spark, sf_dir), "area_id")


def q_fixes_by_polygon(spark, sf_dir):
    """The same over polygons."""
    return areas.count_in_areas(track_points(spark, sf_dir), area_rings(spark, sf_dir), "area_id", ring="ring")


def track_days(spark, sf_dir):
    """States of four files of fixes, taken in one after the other: a week each, but the fixes of every tenth id are dealt by
    number, so that their files overlap."""
    fixes = track_points(spark, sf_dir)
    week = F.least(F.floor((F.dayofmonth("Date") - 1) / F.lit(7)), F.lit(3))
    source = F.when(F.col("id") % 10 == 0, F.col("row_order") % 4).otherwise(week)
    table = states.StateTable(spark, work_folder(spark, "states"))
    for n in range(4):
        states.add_tracks(table, f"file-{n}", fixes.where(source == n))
    return states.track_days(table, lambda ids: fixes.join(ids, "id", "left_semi"))


def q_track_summary_incremental(spark, sf_dir):
    """AGG-5 from the states of files that came one by one."""
    return states.summary_report(track_days(spark, sf_dir))


def q_monthly_patterns_incremental(spark, sf_dir):
    """AGG-20/21 likewise."""
    return rounded(states.monthly_patterns(track_days(spark, sf_dir)), {"avg_distance": 6, "avg_speed": 6})


def q_density_pyramid(spark, sf_dir):
    """AGG-25 at every zoom from the globe to 512 by 512 cells, with the spread over neighbours."""
    return pyramid.density_pyramid(track_points(spark, sf_dir), depth=9)


def track_files(spark, sf_dir):
    """The tracks' text written as CSV files of two headers; the folder."""
    text, folder, n = track_text(spark, sf_dir), work_folder(spark, "csv"), F.col("row_order")
    text.where(n % 2 == 0).select("id", "Date", "Latitude", "Longitude", "note").write.option("header", True).csv(f"{folder}/a")
    text.where(n % 2 == 1).select("Longitude", "id", n.alias("depth"), "Date").write.option("header", True).csv(f"{folder}/b")
    return folder


def q_track_types(spark, sf_dir):
    """SRC-1: types of the columns of files whose headers differ, folded file by file and merged."""
    rows = infer.read_text(spark, track_files(spark, sf_dir))
    return infer.types(infer.merged(infer.profile(rows, "file")))


def q_track_inferred(spark, sf_dir):
    """The same files read as one typed table."""
    return infer.read(spark, track_files(spark, sf_dir), file_column=None).select("id", "Latitude", "Longitude", "note", "depth")


QUERIES = {
    "density_pyramid": q_density_pyramid,
    "track_types": q_track_types,
    "track_inferred": q_track_inferred,
    "track_summary_incremental": q_track_summary_incremental,
    "monthly_patterns_incremental": q_monthly_patterns_incremental,
    "fixes_by_area": q_fixes_by_area,
    "fixes_by_polygon": q_fixes_by_polygon,
    "track_overview": q_track_overview,
    "track_raw_profile": q_track_raw_profile,
    "track_parsed": q_track_parsed,
    "track_temporal_features": q_track_temporal_features,
    "track_movement_metrics": q_track_movement_metrics,
    "track_cumulative_distance": q_track_cumulative_distance,
    "track_spatial_features": q_track_spatial_features,
    "track_clean": q_track_clean,
    "track_clean_accounting": q_track_clean_accounting,
    "track_totals": q_track_totals,
    "track_summary": q_track_summary,
    "track_summary_report": q_track_summary_report,
    "track_sampled": q_track_sampled,
    "track_sampled_per_id": q_track_sampled_per_id,
    "track_clean_first": q_track_clean_first,
    "track_endpoints": q_track_endpoints,
    "track_polylines": q_track_polylines,
    "track_density": q_track_density,
    "map_center": q_map_center,
    "movement_by_date": q_movement_by_date,
    "movement_by_day": q_movement_by_day,
    "records_by_month": q_records_by_month,
    "monthly_patterns": q_monthly_patterns,
    "distance_histogram": q_distance_histogram,
}

# ---------------------------------------------------------------------------------------------
# SQL twins (DuckDB dialect).  The CTE chain restates the stand-in and the whole track pass.

TRACK_CTES = """
tp AS (
  SELECT user_id AS id, ts AS "Date",
         CAST(50.0131 AS DOUBLE) + CAST(0.047 AS DOUBLE) * TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS Latitude,
         CAST(1.0037 AS DOUBLE) + value / 25 AS Longitude,
         event_id AS row_order
  FROM events),
m0 AS (
  SELECT *,
         Latitude - lag(Latitude) OVER w AS lat_diff,
         Longitude - lag(Longitude) OVER w AS lon_diff,
         (epoch_us("Date") - epoch_us(lag("Date") OVER w)) / CAST(86400e6 AS DOUBLE) AS time_diff
  FROM tp WHERE id IS NOT NULL
  WINDOW w AS (PARTITION BY id ORDER BY "Date" ASC NULLS LAST, row_order ASC NULLS LAST)),
m1 AS (SELECT *, sqrt(lat_diff * lat_diff + lon_diff * lon_diff) AS distance FROM m0),
m2 AS (
  SELECT *,
         distance / nullif(time_diff, 0) AS speed,
         atan2(lon_diff, lat_diff) * 180 / pi() AS direction,
         CASE WHEN distance IS NOT NULL THEN sum(distance) OVER (PARTITION BY id ORDER BY "Date" ASC NULLS LAST,
              row_order ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cumulative_distance,
         avg(Latitude) OVER (PARTITION BY id) AS center_lat,
         avg(Longitude) OVER (PARTITION BY id) AS center_lon,
         round_even(Latitude * 10, 0) / 10 AS lat_bin,
         round_even(Longitude * 10, 0) / 10 AS lon_bin,
         CAST(month("Date") AS INTEGER) AS month,
         CASE WHEN month("Date") IN (12, 1, 2) THEN 'Winter' WHEN month("Date") IN (3, 4, 5) THEN 'Spring'
              WHEN month("Date") IN (6, 7, 8) THEN 'Summer' WHEN month("Date") IN (9, 10, 11) THEN 'Autumn' END AS season
  FROM m1),
pt AS (
  SELECT *, sqrt((Latitude - center_lat) * (Latitude - center_lat) + (Longitude - center_lon) * (Longitude - center_lon))
            AS dist_from_center
  FROM m2),
cl AS (
  SELECT * FROM pt
  WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
    AND Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20
    AND speed <= 10 AND time_diff > 0),
smp AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY id, "Date" ASC NULLS LAST, row_order) - 1 AS gi FROM cl)
  WHERE gi % 3 = 0),
mpts AS (SELECT * FROM cl WHERE id IN (SELECT id FROM cl GROUP BY id HAVING count(*) > 1)),
srep AS (
  SELECT id, round_even(coalesce(sum(distance), 0) * 10000, 0) / 10000 AS distance_sum,
         round_even(avg(distance) * 10000, 0) / 10000 AS distance_mean,
         round_even(max(distance) * 10000, 0) / 10000 AS distance_max,
         round_even(avg(speed) * 10000, 0) / 10000 AS speed_mean,
         round_even(max(speed) * 10000, 0) / 10000 AS speed_max,
         count("Date") AS "Date_count"
  FROM cl GROUP BY id)
"""


def _sql(body: str) -> str:
    return "WITH " + TRACK_CTES.strip() + "\n" + body


_IN_AREA = 'SELECT area_id, count(*) AS n_points, count(DISTINCT id) AS n_ids, min("Date") AS first_time, max("Date") AS last_time'
ORACLE = {
    "density_pyramid": _sql("""
, c9 AS (
  SELECT CAST(greatest(0, least(floor((Longitude + 180) / 360 * 512), 511)) AS BIGINT) AS x, CAST(greatest(0, least(floor((Latitude + 90) / 180 * 512), 511)) AS BIGINT) AS y
  FROM tp WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL),
lv AS (SELECT zoom, x >> (9 - zoom) AS x, y >> (9 - zoom) AS y, count(*) AS n FROM c9, (SELECT unnest(range(0, 10)) AS zoom) GROUP BY ALL),
sh AS (
  SELECT zoom, ((x + dx) % (1 << zoom) + (1 << zoom)) % (1 << zoom) AS x, greatest(0, least(y + dy, (1 << zoom) - 1)) AS y,
         n * (2 - abs(dx)) * (2 - abs(dy)) AS share, CASE WHEN dx = 0 AND dy = 0 THEN n ELSE 0 END AS own
  FROM lv, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy))
SELECT CAST(zoom AS INTEGER) AS zoom,
       CAST(list_sum(list_transform(range(0, 9), lambda i: ((x >> i) & 1) * (1 << (2 * i)) + ((y >> i) & 1) * (1 << (2 * i + 1)))) AS BIGINT) AS cell,
       CAST(sum(own) AS BIGINT) AS n_points, sum(share) / CAST(16 AS DOUBLE) AS density,
       (y + CAST(0.5 AS DOUBLE)) / (1 << zoom) * 180 - 90 AS lat, (x + CAST(0.5 AS DOUBLE)) / (1 << zoom) * 360 - 180 AS lon
FROM sh GROUP BY zoom, x, y"""),
    "track_types": _sql("""
SELECT 'id' AS column, 'whole' AS type, count(*) AS n_rows, count(id) AS n_given FROM tp
UNION ALL SELECT 'Date', 'text', count(*), count(*) FROM tp
UNION ALL SELECT 'Latitude', 'number', count(*), count(*) FILTER (WHERE row_order % 2 = 0 AND row_order % 40 <> 0 AND Latitude IS NOT NULL) FROM tp
UNION ALL SELECT 'Longitude', 'text', count(*), count(*) FROM tp
UNION ALL SELECT 'note', 'text', count(*), count(*) FILTER (WHERE row_order % 2 = 0) FROM tp
UNION ALL SELECT 'depth', 'whole', count(*), count(*) FILTER (WHERE row_order % 2 = 1) FROM tp"""),
    "track_inferred": _sql("""
SELECT id, CASE WHEN row_order % 2 = 0 AND row_order % 40 <> 0 THEN Latitude END AS Latitude,
       CASE WHEN row_order % 30 = 0 THEN 'east' ELSE CAST(Longitude AS VARCHAR) END AS Longitude,
       CASE WHEN row_order % 2 = 0 THEN 'n' || CAST(row_order AS VARCHAR) END AS note, CASE WHEN row_order % 2 = 1 THEN row_order END AS depth
FROM tp"""),
    "fixes_by_area": _sql(f"""
, bx AS (
  SELECT c_custkey AS area_id, CAST(49.9007 AS DOUBLE) + CAST(0.0331 AS DOUBLE) * (c_custkey % 151) AS y, CAST(0.9011 AS DOUBLE) + CAST(0.0271 AS DOUBLE) * (c_custkey % 163) AS x,
         CAST([0.02, 0.05, 0.1, 0.3][c_custkey % 4 + 1] AS DOUBLE) AS side
  FROM customer),
ar AS (
  SELECT area_id, CASE WHEN area_id % 103 = 0 THEN y + 1 WHEN area_id % 100 = 0 THEN -60.0 ELSE y END AS lat_min,
         CASE WHEN area_id % 107 <> 0 THEN y + side END AS lat_max, CASE WHEN area_id % 101 = 0 THEN CAST(2.9003 AS DOUBLE) ELSE x END AS lon_min,
         CASE WHEN area_id % 101 = 0 THEN -170.0 WHEN area_id % 100 = 0 THEN 170.0 ELSE x + side END AS lon_max
  FROM bx)
{_IN_AREA}
FROM tp JOIN ar ON Latitude BETWEEN lat_min AND lat_max
  AND CASE WHEN lon_min <= lon_max THEN Longitude BETWEEN lon_min AND lon_max ELSE Longitude >= lon_min OR Longitude <= lon_max END
GROUP BY area_id"""),
    "fixes_by_polygon": _sql(f"""
, pl AS (
  SELECT c_custkey AS area_id, CAST(50.0007 AS DOUBLE) + CAST(0.0293 AS DOUBLE) * (c_custkey % 157) AS y, CAST(1.0011 AS DOUBLE) + CAST(0.0251 AS DOUBLE) * (c_custkey % 149) AS x,
         CAST(0.1 AS DOUBLE) * (c_custkey % 7 + 1) AS side
  FROM customer),
ed AS (
  SELECT area_id, y + side * e.ay AS ay, x + side * e.ax AS ax, y + side * e.zy AS zy, x + side * e.zx AS zx
  FROM pl, (VALUES (CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.4 AS DOUBLE), CAST(0.5 AS DOUBLE)), (0.4, 0.5, 0.0, 1.0), (0.0, 1.0, 1.0, 0.5), (1.0, 0.5, 0.0, 0.0)) e(ay, ax, zy, zx)),
hit AS (
  SELECT area_id, row_order FROM tp JOIN ed ON (ay > Latitude) <> (zy > Latitude) AND Longitude < ax + (Latitude - ay) / (zy - ay) * (zx - ax)
  GROUP BY area_id, row_order HAVING count(*) % 2 = 1)
{_IN_AREA}
FROM tp JOIN hit USING (row_order) GROUP BY area_id"""),
    "track_overview": _sql("""
SELECT count(*) AS total_records, count(DISTINCT id) AS unique_ids, min("Date") AS date_min, max("Date") AS date_max,
       min(Latitude) AS lat_min, max(Latitude) AS lat_max, min(Longitude) AS lon_min, max(Longitude) AS lon_max
FROM tp"""),
    "track_raw_profile": _sql("""
SELECT count(*) AS rows, min(t) AS date_text_min, max(t) AS date_text_max
FROM (SELECT CASE WHEN row_order % 50 = 0 THEN 'unknown' ELSE strftime("Date", '%Y-%m-%d %H:%M:%S.%f') END AS t FROM tp)"""),
    "track_parsed": _sql("""
SELECT id, CASE WHEN row_order % 50 <> 0 THEN "Date" END AS "Date", CASE WHEN row_order % 40 <> 0 THEN Latitude END AS Latitude,
       CASE WHEN row_order % 30 <> 0 THEN Longitude END AS Longitude, 'n' || row_order AS note, row_order
FROM tp"""),
    "track_temporal_features": _sql("""
SELECT id, "Date", row_order, CAST(year("Date") AS INTEGER) AS year, CAST(month("Date") AS INTEGER) AS month,
       CAST(dayofyear("Date") AS INTEGER) AS day_of_year, CAST(week("Date") AS INTEGER) AS week,
       CAST(isodow("Date") - 1 AS INTEGER) AS day_of_week, CAST(hour("Date") AS INTEGER) AS hour,
       CASE WHEN month("Date") IN (12, 1, 2) THEN 'Winter' WHEN month("Date") IN (3, 4, 5) THEN 'Spring'
            WHEN month("Date") IN (6, 7, 8) THEN 'Summer' WHEN month("Date") IN (9, 10, 11) THEN 'Autumn' END AS season
FROM tp"""),
    "track_movement_metrics": _sql("""
SELECT id, "Date", row_order, Latitude, Longitude, lat_diff, lon_diff, distance, time_diff, speed,
       round(direction, 9) AS direction
FROM pt"""),
    "track_cumulative_distance": _sql("""
SELECT id, "Date", row_order, distance, round(cumulative_distance, 6) AS cumulative_distance FROM pt"""),
    "track_spatial_features": _sql("""
SELECT id, row_order, round(center_lat, 10) AS center_lat, round(center_lon, 10) AS center_lon,
       round(dist_from_center, 8) AS dist_from_center, lat_bin, lon_bin
FROM pt"""),
    "track_clean": _sql("""
SELECT id, "Date", row_order, Latitude, Longitude, distance, time_diff, speed,
       round(cumulative_distance, 6) AS cumulative_distance, lat_bin, lon_bin, season
FROM cl"""),
    "track_clean_accounting": _sql("""
SELECT initial_count, removed_missing_coordinates, removed_outside_box, removed_speed_cap, removed_time_not_positive,
       final_count, initial_count - final_count AS removed_count,
       round((initial_count - final_count) * 100.0 / initial_count, 6) AS removed_pct
FROM (
  SELECT count(*) AS initial_count,
         count(*) FILTER (WHERE NOT (Latitude IS NOT NULL AND Longitude IS NOT NULL)) AS removed_missing_coordinates,
         count(*) FILTER (WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
                          AND NOT (Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20)) AS removed_outside_box,
         count(*) FILTER (WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
                          AND Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20
                          AND NOT coalesce(speed <= 10, false)) AS removed_speed_cap,
         count(*) FILTER (WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
                          AND Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20
                          AND coalesce(speed <= 10, false) AND NOT coalesce(time_diff > 0, false)) AS removed_time_not_positive,
         count(*) FILTER (WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
                          AND Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20
                          AND coalesce(speed <= 10, false) AND coalesce(time_diff > 0, false)) AS final_count
  FROM pt)"""),
    "track_totals": _sql("""
SELECT round(coalesce(sum(distance), 0), 6) AS total_distance, round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed,
       round(avg(distance), 6) AS avg_distance_per_day
FROM cl"""),
    "track_summary": _sql("""
SELECT id, round_even(coalesce(sum(distance), 0) * 10000, 0) / 10000 AS distance_sum,
       round_even(avg(distance) * 10000, 0) / 10000 AS distance_mean,
       round_even(max(distance) * 10000, 0) / 10000 AS distance_max,
       round_even(avg(speed) * 10000, 0) / 10000 AS speed_mean,
       round_even(max(speed) * 10000, 0) / 10000 AS speed_max,
       min("Date") AS "Date_min", max("Date") AS "Date_max", count("Date") AS "Date_count",
       round_even(max(dist_from_center) * 10000, 0) / 10000 AS dist_from_center_max
FROM cl GROUP BY id"""),
    "track_summary_report": _sql("SELECT * FROM srep"),
    "track_sampled": _sql('SELECT id, "Date", row_order, Latitude, Longitude FROM smp'),
    "track_endpoints": _sql("""
SELECT id, arg_min(Latitude, ("Date", row_order)) AS start_lat, arg_min(Longitude, ("Date", row_order)) AS start_lon,
       arg_max(Latitude, ("Date", row_order)) AS end_lat, arg_max(Longitude, ("Date", row_order)) AS end_lon,
       count(*) AS n_points
FROM mpts GROUP BY id"""),
    "track_polylines": _sql("""
SELECT id, row_number() OVER (PARTITION BY id ORDER BY "Date", row_order) - 1 AS point_index, Latitude, Longitude
FROM mpts"""),
    "track_density": _sql("""
SELECT round_even(Latitude * 10, 0) / 10 AS lat_bin, round_even(Longitude * 10, 0) / 10 AS lon_bin, count(*) AS n_points
FROM cl GROUP BY ALL"""),
    "track_sampled_per_id": _sql("""
SELECT id, "Date", row_order, Latitude, Longitude
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "Date" ASC NULLS LAST, row_order) - 1 AS pi FROM cl)
WHERE pi % 3 = 0"""),
    "track_clean_first": _sql("""
, b AS (
  SELECT id, row_order, sqrt(pow(Latitude - lag(Latitude) OVER w, 2) + pow(Longitude - lag(Longitude) OVER w, 2)) AS distance,
         (epoch_us("Date") - epoch_us(lag("Date") OVER w)) / CAST(86400e6 AS DOUBLE) AS time_diff
  FROM tp WHERE id IS NOT NULL AND Latitude BETWEEN 40 AND 70 AND Longitude BETWEEN -20 AND 20
  WINDOW w AS (PARTITION BY id ORDER BY "Date" ASC NULLS LAST, row_order ASC NULLS LAST))
SELECT id, row_order, distance, time_diff, distance / nullif(time_diff, 0) AS speed FROM b"""),
    "map_center": _sql("""
SELECT round(avg(Latitude), 8) AS center_lat, round(avg(Longitude), 8) AS center_lon, count(*) AS n_points FROM cl"""),
    "movement_by_date": _sql("""
SELECT "Date", round(avg(distance), 6) AS avg_distance, round(avg(speed), 6) AS avg_speed,
       round(avg(Latitude), 10) AS avg_lat, round(avg(Longitude), 10) AS avg_lon
FROM cl GROUP BY "Date\""""),
    "movement_by_day": _sql("""
SELECT date_trunc('day', "Date") AS "Date", round(avg(distance), 6) AS avg_distance, round(avg(speed), 6) AS avg_speed,
       round(avg(Latitude), 10) AS avg_lat, round(avg(Longitude), 10) AS avg_lon
FROM cl GROUP BY 1"""),
    "track_summary_incremental": _sql("SELECT * FROM srep"),
    "monthly_patterns_incremental": _sql("""
SELECT month, count(*) AS n_records, round(avg(distance), 6) AS avg_distance, round(avg(speed), 6) AS avg_speed, count(DISTINCT id) AS n_ids
FROM cl GROUP BY month"""),
    "records_by_month": _sql("SELECT month, count(*) AS n_records FROM cl GROUP BY month"),
    "monthly_patterns": _sql("""
SELECT month, round(avg(distance), 6) AS avg_distance, round(avg(speed), 6) AS avg_speed, count(DISTINCT id) AS n_ids
FROM cl GROUP BY month"""),
    "distance_histogram": _sql("""
, st AS (SELECT CASE WHEN min(distance_sum) = max(distance_sum) THEN min(distance_sum) - 0.5 ELSE min(distance_sum) END AS lo,
                CASE WHEN min(distance_sum) = max(distance_sum) THEN max(distance_sum) + 0.5 ELSE max(distance_sum) END AS hi
         FROM srep),
b AS (SELECT LEAST(CAST(floor((distance_sum - lo) * 20 / (hi - lo)) AS INTEGER), 19) AS bin FROM srep, st
      WHERE distance_sum IS NOT NULL),
c AS (SELECT bin, count(*) AS n_ids FROM b GROUP BY bin)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 20), 8) AS bin_lo, round(lo + (g.bin + 1) * ((hi - lo) / 20), 8) AS bin_hi,
       coalesce(c.n_ids, 0) AS n_ids
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 20)) g CROSS JOIN st LEFT JOIN c ON c.bin = g.bin"""),
}
