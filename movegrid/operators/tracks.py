"""Track (time series per entity) operators.

Physical shape of ``process``: the fixes are read twice.  One hash exchange on ``(id, chunk)`` and one
sort feed every per-row window; a small per-chunk table, from the other reading, carries the
previous fix, running-sum offsets and the entity centroid across chunk boundaries.  Chunking
a track by time keeps one very long track (a hot id) from landing in a single task, and time
slices that hold too many fixes are cut further (``chunked``); ``chunk_days=None`` windows
whole tracks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from movegrid.functions.ordering import every_kth
from movegrid.functions.spatial import bearing_degrees, planar_distance, round_half_even, spatial_bin
from movegrid.functions.temporal import calendar_columns, days_between
from movegrid.params import TRACK_LAT_RANGE, TRACK_LON_RANGE, TRACK_MAX_SPEED

REQUIRED = ("id", "Date", "Latitude", "Longitude")
DEFAULT_CHUNK_DAYS = 7
HEAVY_ROWS = 1_000_000     # fixes of one (id, time slice) above which the slice is cut further
HEAVY_SLICES = 10_000      # heavy slices at most, so that the table of their cuts may be broadcast
CUTS = 63                  # cuts by time, and as many by source order, in a heavy slice


def track_order(ts: str = "Date", order: str = "row_order") -> list[Column]:
    """ORD-1: fixes in time order, missing times last, ties in source order (D17, D18)."""
    return [F.col(ts).asc_nulls_last(), F.col(order).asc_nulls_last()]


def chunk_key(ts: str, chunk_days: float | None) -> Column:
    """Time chunk of a fix: whole ``chunk_days`` periods since the epoch (fractions of a day
    allowed, e.g. ``1/24`` for hourly chunks of dense tracks); one chunk when ``None``.

    The per-id chunk table then holds (time span / chunk length) rows per id whatever the
    number of fixes, and one chunk of one id is the largest unit of work of a task.
    Fixes without a time sort last (D17): they form the last chunk, with a non-NULL key so
    that equi-joins back to per-chunk tables match them.
    """
    if chunk_days is None:
        return F.lit(0).cast("long")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col(ts).cast("timestamp_ntz"))
    size = int(round(chunk_days * 86400e6))
    return F.coalesce(F.floor(micros / F.lit(size)).cast("long"), F.lit(2 ** 62).cast("long"))


def chunked(df: DataFrame, id: str = "id", ts: str = "Date", order: str = "row_order",
            chunk_days: float | None = DEFAULT_CHUNK_DAYS, heavy_rows: int | None = None) -> DataFrame:
    """``df`` with ``_chunk``: a key that follows the order of a track's fixes.

    A chunk is a time slice (``chunk_key``).  A slice with more than ``heavy_rows`` fixes is cut
    at quantiles of its times, and fixes that share a cut's very time (all of them, where there
    is no time) at quantiles of their source order, if that is a number.  At most
    ``HEAVY_SLICES`` slices can hold more than that share of all fixes each, so the table of cuts
    is bounded and broadcast.

    Whether there are such slices is found out here: fixes are counted, which needs no column, and only if
    there are more than ``heavy_rows`` of them are slices counted, and only if one is heavy are cuts looked for.
    """
    base = df.withColumn("_chunk", F.struct(chunk_key(ts, chunk_days).alias("slice"), F.lit(0).alias("part"), F.lit(0).alias("sub")))
    least = heavy_rows or HEAVY_ROWS
    if chunk_days is None or (total := df.count()) <= least:
        return base
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at, slice_ = F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz")), chunk_key(ts, chunk_days)
    kind = dict(df.dtypes)[order]
    source = F.col(order) if kind in ("bigint", "int") else F.lit(0)
    rows = df.select(F.col(id).alias("_id"), slice_.alias("_slice"), at.alias("_at"), source.cast("long").alias("_order"))
    counts = rows.groupBy("_id", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.where(F.col("_n") > F.lit(max(least, total / HEAVY_SLICES))).select("_id", "_slice")
    held = heavy.collect()        # at most HEAVY_SLICES rows
    if not held:
        return base
    spark, quantiles = df.sparkSession, [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    cuts = rows.join(F.broadcast(spark.createDataFrame(held, heavy.schema)), ["_id", "_slice"]).groupBy("_id", "_slice").agg(
        F.percentile_approx("_at", quantiles).alias("_times"), F.percentile_approx("_order", quantiles).alias("_orders"))
    cuts = spark.createDataFrame(cuts.collect(), cuts.schema)      # a row per heavy slice
    met = base.withColumn("_at", at).join(F.broadcast(cuts), [F.col(id) == cuts["_id"], F.col("_chunk.slice") == cuts["_slice"]], "left")
    reached = lambda bounds, value: F.coalesce(F.size(F.filter(bounds, lambda b: b <= value)), F.lit(0))
    part = F.when(F.col("_times").isNull() | F.col("_at").isNull(), F.lit(0)).otherwise(reached(F.col("_times"), F.col("_at")))
    at_cut = F.col("_at").isNull() | F.coalesce(F.array_contains("_times", F.col("_at")), F.lit(False))
    sub = F.when(F.col("_orders").isNull(), F.lit(0)).when(at_cut, reached(F.col("_orders"), source.cast("long"))).otherwise(F.lit(CUTS + 1))
    return met.withColumn("_chunk", F.struct(F.col("_chunk.slice").alias("slice"), part.alias("part"), sub.alias("sub"))).select(*df.columns, "_chunk")


def positions(df: DataFrame, id: str = "id", ts: str = "Date", order: str = "row_order",
              chunk_days: float | None = DEFAULT_CHUNK_DAYS, name: str = "position", min_points: int = 1) -> DataFrame:
    """0-based position of every fix within its track, computed per (id, chunk) with chunk
    offsets from a small per-chunk count table, so a very long track is spread over tasks.
    Tracks of fewer than ``min_points`` fixes are left out.  Fixes that are ``chunked`` already keep their chunks."""
    base = df if "_chunk" in df.columns else chunked(df, id, ts, order, chunk_days)
    w = Window.partitionBy(id, "_chunk").orderBy(*track_order(ts, order))
    local = base.withColumn("_rn", F.row_number().over(w))
    counts = base.groupBy(id, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    wid = Window.partitionBy(id)
    before = wid.orderBy(F.col("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(id, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(wid).alias("_total")).where(F.col("_total") >= min_points)
    return (local.join(offsets, [id, "_chunk"])
            .withColumn(name, F.col("_off") + F.col("_rn") - 1)
            .drop("_chunk", "_rn", "_off", "_total"))


def check_required(df: DataFrame, required=REQUIRED) -> DataFrame:
    """SRC-1 contract: raise when a required column is missing (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def overview(df: DataFrame, id: str = "id", ts: str = "Date", lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """AGG-1: one-row overview of the raw (uncleaned) tracks."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct(id).alias("unique_ids"),
        F.min(ts).alias("date_min"),
        F.max(ts).alias("date_max"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
    )


def with_calendar(df: DataFrame, ts: str = "Date") -> DataFrame:
    """PRJ-1 + PRJ-2."""
    return df.withColumns(calendar_columns(F.col(ts)))


def process(df: DataFrame, id: str = "id", ts: str = "Date", lat: str = "Latitude", lon: str = "Longitude",
            order: str = "row_order", chunk_days: float | None = DEFAULT_CHUNK_DAYS, cumulative: bool = True,
            clean_first: bool = False, heavy_rows: int | None = None) -> DataFrame:
    """Calendar features, movement metrics and spatial features of every fix (before cleaning, D1).

    Adds ``lat_diff, lon_diff, distance, time_diff, speed, direction, cumulative_distance``
    (WIN-1..3, PRJ-5..7) and ``center_lat, center_lon, dist_from_center, lat_bin, lon_bin``
    (JN-1/WIN-7, PRJ-4, PRJ-8).  Rows with a NULL id are dropped (D24).  ``cumulative=False``
    leaves ``cumulative_distance`` out and with it a second pass over the windows;
    ``clean_first`` measures steps between fixes with coordinates inside the box only (D1 option).
    """
    check_required(df, (id, ts, lat, lon, order))
    known = df.where(F.col(id).isNotNull())
    if clean_first:
        for _, rule in clean_predicates(lat, lon)[:2]:
            known = known.where(rule)
    base = chunked(known, id, ts, order, chunk_days, heavy_rows)

    w = Window.partitionBy(id, "_chunk").orderBy(*track_order(ts, order))
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Few DataFrame steps on purpose: each step re-analyses the whole plan on the driver.
    local = base.select("*", F.row_number().over(w).alias("_rn"), F.lag(lat).over(w).alias("_plat"),
                        F.lag(lon).over(w).alias("_plon"), F.lag(ts).over(w).alias("_pts"))
    # Per-chunk table: first and last fix, coordinate sums for the centroid, the sum of the steps inside.
    fix = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(ts).alias("ts"))
    place = F.struct(F.col(ts).isNull(), F.col(ts), F.col(order))
    wid = Window.partitionBy(id)
    wc = wid.orderBy(F.col("_chunk"))
    inside = []
    if cumulative:
        # steps inside a chunk are summed per chunk, then carried forward along the track
        step = planar_distance(F.col(lat) - F.col("_plat"), F.col(lon) - F.col("_plon"))
        local = local.withColumn("_icum", F.sum(step).over(w_run))
        inside = [F.max_by("_icum", "_rn").alias("_isum")]
    chunks = (local if cumulative else base).groupBy(id, "_chunk").agg(
        F.min_by(fix, place).alias("_first"), F.max_by(fix, place).alias("_last"),
        F.sum(lat).alias("_slat"), F.count(lat).alias("_nlat"),
        F.sum(lon).alias("_slon"), F.count(lon).alias("_nlon"), *inside,
    ).select("*", F.lag("_last").over(wc).alias("_carry"),
             (F.sum("_slat").over(wid) / F.sum("_nlat").over(wid)).alias("center_lat"),
             (F.sum("_slon").over(wid) / F.sum("_nlon").over(wid)).alias("center_lon"))
    if cumulative:
        first_dist = planar_distance(F.col("_first.lat") - F.col("_carry.lat"), F.col("_first.lon") - F.col("_carry.lon"))
        total = F.coalesce(F.col("_fdist"), F.lit(0.0)) + F.coalesce(F.col("_isum"), F.lit(0.0))
        chunks = chunks.withColumn("_fdist", first_dist).withColumn(
            "_offset", F.coalesce(F.sum(total).over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    chunks = chunks.drop("_first", "_last", "_isum", "_slat", "_nlat", "_slon", "_nlon")

    j = local.join(chunks, [id, "_chunk"], "left")
    first = F.col("_rn") == 1
    lat_diff = F.col(lat) - F.when(first, F.col("_carry.lat")).otherwise(F.col("_plat"))
    lon_diff = F.col(lon) - F.when(first, F.col("_carry.lon")).otherwise(F.col("_plon"))
    time_diff = days_between(F.when(first, F.col("_carry.ts")).otherwise(F.col("_pts")), F.col(ts))
    distance = planar_distance(lat_diff, lon_diff)
    keep = [c for c in df.columns if c != "_chunk"]
    derived = {
        "lat_diff": lat_diff,
        "lon_diff": lon_diff,
        "distance": distance,
        "time_diff": time_diff,
        "speed": distance / F.nullif(time_diff, F.lit(0.0)),
        "direction": bearing_degrees(lat_diff, lon_diff),
        "center_lat": F.col("center_lat"),
        "center_lon": F.col("center_lon"),
        "dist_from_center": planar_distance(F.col(lat) - F.col("center_lat"), F.col(lon) - F.col("center_lon")),
        "lat_bin": spatial_bin(F.col(lat)),
        "lon_bin": spatial_bin(F.col(lon)),
        **calendar_columns(F.col(ts)),
    }
    if cumulative:
        # WIN-3: a missing step stays missing, the sum continues past it
        running = F.col("_offset") + F.coalesce(F.col("_fdist"), F.lit(0.0)) + F.coalesce(F.col("_icum"), F.lit(0.0))
        derived["cumulative_distance"] = F.when(distance.isNotNull(), running)
    return j.select(*[F.col(c) for c in keep], *[e.alias(n) for n, e in derived.items()])


def clean_predicates(lat: str = "Latitude", lon: str = "Longitude", lat_range=TRACK_LAT_RANGE,
                     lon_range=TRACK_LON_RANGE, max_speed: float = TRACK_MAX_SPEED) -> list[tuple[str, Column]]:
    """FIL-1..4 in application order; a NULL predicate removes the row."""
    return [
        ("missing_coordinates", F.col(lat).isNotNull() & F.col(lon).isNotNull()),
        ("outside_box", F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range)),
        ("speed_cap", F.coalesce(F.col("speed") <= F.lit(max_speed), F.lit(False))),
        ("time_not_positive", F.coalesce(F.col("time_diff") > F.lit(0.0), F.lit(False))),
    ]


def clean(df: DataFrame, **kw) -> DataFrame:
    """FIL-1..4: drop missing coordinates, outside the box, speed above the cap or missing, time_diff <= 0."""
    cond = None
    for _, p in clean_predicates(**kw):
        cond = p if cond is None else cond & p
    return df.where(cond)


def clean_accounting(df: DataFrame, **kw) -> DataFrame:
    """FIL-5: rows removed by each rule (in order) and overall, in one pass."""
    preds = clean_predicates(**kw)
    aggs = [F.count(F.lit(1)).alias("initial_count")]
    alive = F.lit(True)
    for name, p in preds:
        aggs.append(F.count_if(alive & ~p).alias(f"removed_{name}"))
        alive = alive & p
    aggs.append(F.count_if(alive).alias("final_count"))
    out = df.agg(*aggs)
    return out.withColumns({
        "removed_count": F.col("initial_count") - F.col("final_count"),
        "removed_pct": F.try_divide((F.col("initial_count") - F.col("final_count")) * F.lit(100.0),
                                    F.col("initial_count")),
    })


def totals(df: DataFrame) -> DataFrame:
    """AGG-3 on cleaned tracks; an empty sum is 0 (D5)."""
    return df.agg(
        F.coalesce(F.sum("distance"), F.lit(0.0)).alias("total_distance"),
        F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        F.avg("distance").alias("avg_distance_per_day"),
    )


def summary(df: DataFrame, id: str = "id", ts: str = "Date", decimals: int = 4) -> DataFrame:
    """AGG-4: per-entity summary rounded half-even to ``decimals`` (PRJ-15, PRJ-19)."""
    r = lambda c: round_half_even(c, decimals)
    return df.groupBy(id).agg(
        r(F.coalesce(F.sum("distance"), F.lit(0.0))).alias("distance_sum"),
        r(F.avg("distance")).alias("distance_mean"),
        r(F.max("distance")).alias("distance_max"),
        r(F.avg("speed")).alias("speed_mean"),
        r(F.max("speed")).alias("speed_max"),
        F.min(ts).alias(f"{ts}_min"),
        F.max(ts).alias(f"{ts}_max"),
        F.count(ts).alias(f"{ts}_count"),
        r(F.max("dist_from_center")).alias("dist_from_center_max"),
    )


def summary_report(df: DataFrame, id: str = "id", ts: str = "Date", decimals: int = 4) -> DataFrame:
    """AGG-5: the report variant (no centre distance, date count only)."""
    r = lambda c: round_half_even(c, decimals)
    return df.groupBy(id).agg(
        r(F.coalesce(F.sum("distance"), F.lit(0.0))).alias("distance_sum"),
        r(F.avg("distance")).alias("distance_mean"),
        r(F.max("distance")).alias("distance_max"),
        r(F.avg("speed")).alias("speed_mean"),
        r(F.max("speed")).alias("speed_max"),
        F.count(ts).alias(f"{ts}_count"),
    )


def sampled(df: DataFrame, k: int = 3, id: str = "id", ts: str = "Date", order: str = "row_order",
            columns: list[str] | None = None) -> DataFrame:
    """WIN-5: every k-th fix of the table sorted by (id, time, source order), from row 0.

    Only ``columns`` (default: id, time, order and position) are carried: the exact index
    checkpoints its input, and column pruning cannot reach through a checkpoint.
    """
    keep = columns or [id, ts, order, "Latitude", "Longitude"]
    return every_kth(df.select(*keep), [F.col(id).asc_nulls_last()] + track_order(ts, order), k)


def sampled_per_id(df: DataFrame, k: int = 3, id: str = "id", ts: str = "Date", order: str = "row_order") -> DataFrame:
    """WIN-5, the option without a global order (D28): every k-th fix of each track."""
    return positions(df, id, ts, order, name="_at").where(F.pmod(F.col("_at"), F.lit(k)) == 0).drop("_at")


def first_ids(df: DataFrame, n: int, id: str = "id") -> DataFrame:
    """ORD-4: the first ``n`` ids of the id-sorted table, for a drawing that shows only some."""
    return df.select(id).distinct().orderBy(F.col(id).asc_nulls_last()).limit(n)


def of_ids(df: DataFrame, ids: DataFrame, id: str = "id") -> DataFrame:
    """FIL-15/JN-10: fixes of the given ids (Spark chooses the join by their measured size)."""
    return df.join(ids, id, "left_semi")


def endpoints(df: DataFrame, id: str = "id", ts: str = "Date", lat: str = "Latitude",
              lon: str = "Longitude", order: str = "row_order") -> DataFrame:
    """WIN-4, FIL-16: first and last fix of every track with more than one fix."""
    key = F.struct(F.col(ts).isNull(), F.col(ts), F.col(order))
    return df.groupBy(id).agg(
        F.min_by(F.col(lat), key).alias("start_lat"),
        F.min_by(F.col(lon), key).alias("start_lon"),
        F.max_by(F.col(lat), key).alias("end_lat"),
        F.max_by(F.col(lon), key).alias("end_lon"),
        F.count(F.lit(1)).alias("n_points"),
    ).where(F.col("n_points") > 1)


def polylines(df: DataFrame, id: str = "id", ts: str = "Date", lat: str = "Latitude",
              lon: str = "Longitude", order: str = "row_order") -> DataFrame:
    """WIN-6, FIL-16: ordered polyline of every track with more than one fix, in long form
    (id, point_index, lat, lon).

    Long form keeps a long track spread over rows instead of one giant array, and the
    positions are computed per chunk (``positions``), not in one task per track.
    """
    return positions(df, id, ts, order, name="point_index", min_points=2).select(id, "point_index", lat, lon)
