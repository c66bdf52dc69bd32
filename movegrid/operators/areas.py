"""Points in areas, for any number of areas: boxes, boxes over the antimeridian, and polygons.

The globe is a quadtree: at level ``L`` it has 2**L cells along each axis.  An area is covered by the
cells of one level that its box touches, the finest of ``LEVELS`` at which these are at most
``(SIDE + 1)**2``.  A point has one cell per level that areas use, so points meet areas in an equi-join on
(level, cell), which Spark broadcasts, shuffles or splits by measured sizes, and an exact test decides.  As
the cell of a coordinate never falls when the coordinate grows, no point of an area is outside its cover.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from movegrid.operators import area_counts

LEVELS = (0, 3, 6, 9, 12, 15)
PIECES = 16       # boxes or polygons of one area that are looked up together, at most
POINTS, SHAPES = 100_000, 10_000      # of a block of ``count_in_areas``
SIDE = 8          # cells along a side of a cover, at most (a step of three levels is a factor of eight)


def _index(c: Column, low: float, span: float, level: Column) -> Column:
    """Cell along one axis, monotone in the coordinate; what lies off the globe belongs to the outermost cells."""
    n = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    at = F.floor((c - F.lit(low)) / F.lit(span) * n).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(at, n - 1))


def _key(y: Column, x: Column) -> Column:
    return F.shiftleft(y, 20) + x


def boxes(areas: DataFrame, wrap_antimeridian: bool = True) -> DataFrame:
    """``areas`` (lat_min, lat_max, lon_min, lon_max) as plain boxes: one that crosses the antimeridian (lon_min > lon_max) becomes
    two, or none without ``wrap_antimeridian`` (D13); those with a missing or NaN bound or lat_min > lat_max go."""
    ends = ["lat_min", "lat_max", "lon_min", "lon_max"]
    known = areas
    for c in ends:
        known = known.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    known = known.where("lat_min <= lat_max")
    straight = known.where("lon_min <= lon_max")
    if not wrap_antimeridian:
        return straight
    over = known.where("lon_min > lon_max")
    return straight.unionByName(over.withColumn("lon_max", F.lit(180.0))).unionByName(over.withColumn("lon_min", F.lit(-180.0)))


def ring_box(areas: DataFrame, ring: str = "ring") -> DataFrame:
    """Polygons (``ring``: array of (lat, lon), first point not repeated) with the box around each."""
    lat, lon = F.col(f"{ring}.lat"), F.col(f"{ring}.lon")
    return areas.withColumns({"lat_min": F.array_min(lat), "lat_max": F.array_max(lat), "lon_min": F.array_min(lon), "lon_max": F.array_max(lon)})


def in_ring(ring: Column, lat: Column, lon: Column) -> Column:
    """Even-odd rule: whether a ray to greater longitudes crosses an odd number of the polygon's edges."""
    def crossed(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % F.size(ring))
        turn = a["lon"] + (lat - a["lat"]) / (b["lat"] - a["lat"]) * (b["lon"] - a["lon"])
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < turn)
    return (F.size(F.filter(F.sequence(F.lit(0), F.size(ring) - 1), crossed)) % 2 == 1) & (F.size(ring) > 2)


def cover(areas: DataFrame) -> DataFrame:
    """A row per area and cell that its box touches: the columns of ``areas`` and ``_level``, ``_cell``."""
    def corner(level: int) -> list[Column]:
        at = F.lit(level)
        return [_index(F.col("lat_min"), -90.0, 180.0, at), _index(F.col("lat_max"), -90.0, 180.0, at),
                _index(F.col("lon_min"), -180.0, 360.0, at), _index(F.col("lon_max"), -180.0, 360.0, at)]

    fits = F.lit(LEVELS[0])
    for level in LEVELS[1:]:
        y0, y1, x0, x1 = corner(level)
        fits = F.when((y1 - y0 <= SIDE) & (x1 - x0 <= SIDE), F.lit(level)).otherwise(fits)
    at = areas.withColumn("_level", fits)
    level = F.col("_level")
    rows = at.withColumns({
        "_ys": F.sequence(_index(F.col("lat_min"), -90.0, 180.0, level), _index(F.col("lat_max"), -90.0, 180.0, level)),
        "_xs": F.sequence(_index(F.col("lon_min"), -180.0, 360.0, level), _index(F.col("lon_max"), -180.0, 360.0, level))})
    cells = F.flatten(F.transform("_ys", lambda y: F.transform("_xs", lambda x: _key(y, x))))
    return rows.withColumn("_cell", F.explode(cells)).drop("_ys", "_xs")


def locate(points: DataFrame, areas: DataFrame, keep: list[str], lat: str = "Latitude", lon: str = "Longitude", ring: str | None = None,
           wrap_antimeridian: bool = True) -> DataFrame:
    """JN-5/FIL-13: a row per point and area that holds it: the columns of ``points`` and ``keep`` of ``areas``.

    Bounds are inclusive.  ``areas`` has lat_min, lat_max, lon_min, lon_max or, with ``ring``, polygons, whose edges follow
    the even-odd rule and don't cross the antimeridian.  Points without coordinates are in no area, repeated points and
    areas each count, and a point in many areas has a row for each.  No name in ``keep`` may be a column of ``points``.
    """
    clash = set(points.columns) & set(keep)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    ends = {"_lat_min": "lat_min", "_lat_max": "lat_max", "_lon_min": "lon_min", "_lon_max": "lon_max"}
    plain = boxes(ring_box(areas, ring) if ring else areas, wrap_antimeridian and not ring)
    covered = cover(plain).select("_level", "_cell", *[F.col(c).alias(a) for a, c in ends.items()], *[F.col(c).alias(c) for c in keep],
                                  *([F.col(ring).alias("_ring")] if ring else []))
    levels = F.array(*[F.lit(level) for level in LEVELS])
    used = plain_levels(covered)
    if used:
        levels = F.array(*[F.lit(level) for level in used])
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    there = points.where(y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x))
    spots = there.withColumn("_level", F.explode(levels)).withColumn(
        "_cell", _key(_index(y, -90.0, 180.0, F.col("_level")), _index(x, -180.0, 360.0, F.col("_level"))))
    inside = y.between(F.col("_lat_min"), F.col("_lat_max")) & x.between(F.col("_lon_min"), F.col("_lon_max"))
    met = spots.join(covered, ["_level", "_cell"]).where(inside)
    if ring:
        met = met.where(in_ring(F.col("_ring"), y, x))
    return met.select(*points.columns, *keep)


def plain_levels(covered: DataFrame) -> list[int]:
    """The levels that the areas use, at most all of ``LEVELS``: points get a row for these only."""
    return sorted(r[0] for r in covered.select("_level").distinct().collect())


def count_in_areas(points: DataFrame, areas: DataFrame, area: str, id: str = "id", ts: str = "Date", lat: str = "Latitude", lon: str = "Longitude",
                   ring: str | None = None, wrap_antimeridian: bool = True) -> DataFrame:
    """Per area with a point: n_points, n_ids, first and last time.

    As many rows of ``locate`` as points times areas aren't made: shapes meet points in blocks of bounded size (``area_counts``),
    equal shapes once.  An area whose rows are more than ``PIECES`` different boxes or polygons is counted from ``locate``.
    """
    if area in points.columns:
        raise ValueError(f"columns on both sides: {[area]}")
    ends = ["lat_min", "lat_max", "lon_min", "lon_max"]
    plain = boxes(ring_box(areas, ring) if ring else areas, wrap_antimeridian and not ring).select(
        F.col(area).alias("_area"), *[F.col(c).cast("double").alias(c) for c in ends], *([F.col(ring).alias("ring")] if ring else []))
    if ring:
        plain = plain.where(F.size("ring") > 2)
    piece = [*ends, *(["ring"] if ring else [])]
    pieces = plain.groupBy("_area", *piece).agg(F.count(F.lit(1)).alias("times")).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_area")))
    shaped = pieces.where(F.col("_n") <= PIECES).groupBy("_area").agg(F.sort_array(F.collect_list(F.struct(*piece, "times"))).alias("_pieces"))
    found = _counted(points, shaped.select("_pieces").distinct(), id, ts, lat, lon, bool(ring))
    counted = shaped.join(found, "_pieces").select(F.col("_area").alias(area), "n_points", "n_ids", "first_time", "last_time")
    if pieces.where(F.col("_n") > PIECES).isEmpty():
        return counted
    many = pieces.where(F.col("_n") > PIECES).select("_area", *piece, F.explode(F.sequence(F.lit(1), F.col("times"))))
    rest = locate(points, many, ["_area"], lat, lon, ring="ring" if ring else None).groupBy("_area").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_distinct(id).alias("n_ids"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))
    return counted.unionByName(rest.withColumnRenamed("_area", area))


def _counted(points: DataFrame, shapes: DataFrame, id: str, ts: str, lat: str, lon: str, polygons: bool) -> DataFrame:
    """(_pieces, n_points, n_ids, first_time, last_time) of the ``shapes`` (_pieces) that hold a point."""
    least, most = (lambda c: F.array_min(F.col(f"_pieces.{c}"))), (lambda c: F.array_max(F.col(f"_pieces.{c}")))

    def corner(level: Column) -> list[Column]:
        return [_index(least("lat_min"), -90.0, 180.0, level), _index(most("lat_max"), -90.0, 180.0, level),
                _index(least("lon_min"), -180.0, 360.0, level), _index(most("lon_max"), -180.0, 360.0, level)]

    fits = F.lit(LEVELS[0])
    for level in LEVELS[1:]:
        y0, y1, x0, x1 = corner(F.lit(level))
        fits = F.when((y1 - y0 <= 1) & (x1 - x0 <= 1), F.lit(level)).otherwise(fits)
    y0, _, x0, _ = corner(F.col("_level"))
    homed = shapes.withColumn("_level", fits).withColumn("_cell", _key(y0, x0))
    homes = homed.groupBy("_level", "_cell").agg(F.count(F.lit(1)).alias("_shapes"))
    used = plain_levels(homes)
    y, x = F.col("_y"), F.col("_x")
    there = points.select(F.col(lat).cast("double").alias("_y"), F.col(lon).cast("double").alias("_x"), F.col(id).alias("_id"), F.col(ts).alias("_t")).where(
        y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x))
    placed = there.withColumn("_level", F.explode(F.array(*[F.lit(level) for level in used or LEVELS]))).withColumns({
        "_yi": _index(y, -90.0, 180.0, F.col("_level")), "_xi": _index(x, -180.0, 360.0, F.col("_level"))})
    yi, xi = F.col("_yi"), F.col("_xi")
    near = F.explode(F.array(*[F.when((yi >= i) & (xi >= j), _key(yi - i, xi - j)) for i in (0, 1) for j in (0, 1)]))
    spots = placed.withColumn("_cell", near).where("_cell IS NOT NULL").drop("_yi", "_xi")
    # one dealing by level and cell: shards of ids, parts of shapes
    held = placed.groupBy("_level", "_yi", "_xi").agg(F.count(F.lit(1)).alias("_points")).withColumn("_cell", near)
    sizes = held.groupBy("_level", "_cell").agg(F.sum("_points").alias("_points")).join(homes, ["_level", "_cell"]).select(
        "_level", "_cell", F.ceil(F.col("_points") / POINTS).cast("int").alias("_shards"), F.ceil(F.col("_shapes") / SHAPES).cast("int").alias("_parts"))
    key = ["_level", "_cell", "_shard", "_part"]
    by_id = F.when(F.col("_id").isNull(), F.xxhash64("_y", "_x", "_t")).otherwise(F.xxhash64("_id"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = spots.join(sizes, ["_level", "_cell"]).select(
        "_level", "_cell", F.pmod(by_id, F.col("_shards")).cast("int").alias("_shard"), upto("_parts").alias("_part"), "_y", "_x", "_id", "_t")
    right = homed.join(sizes, ["_level", "_cell"]).select(
        "_level", "_cell", upto("_shards").alias("_shard"), F.pmod(F.xxhash64("_pieces"), F.col("_parts")).cast("int").alias("_part"), "_pieces")

    def run(some, shapes):
        out = [(shapes["_pieces"].take(pa.array(at)), *rest) for at, *rest in area_counts.counts(some, shapes, polygons)]
        kinds = [shapes.schema.field("_pieces").type, pa.int64(), pa.int64(), *[some.schema.field("_t").type] * 2]
        columns = [pa.chunked_array([c for x in one for c in (x.chunks if isinstance(x, pa.ChunkedArray) else [pa.array(x)])], t)
                   for one, t in zip(zip(*out) if out else [()] * 5, kinds)]
        return pa.table(columns, names=["_pieces", "n_points", "n_ids", "first_time", "last_time"])

    time = there.schema["_t"].dataType
    schema = shapes.schema.add("n_points", "long").add("n_ids", "long").add("first_time", time).add("last_time", time)
    blocks = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)
    return blocks.groupBy("_pieces").agg(F.sum("n_points").alias("n_points"), F.sum("n_ids").alias("n_ids"),
                                         F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))
