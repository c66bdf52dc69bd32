"""Density of fixes by zoom level: counts in quadtree cells, and a smooth spread over neighbours (AGG-25).

A cell at zoom ``z`` is one of 2**z by 2**z; its Morton key interleaves the bits of its column and row, so the
cell that holds it at a lower zoom is a prefix of its key.  Fixes are counted once, at the deepest zoom; all levels are
then one aggregation over prefixes of those counts, and the kernel works on counted cells, never on fixes.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

DEPTH = 12
KERNEL = ((1, 2, 1), (2, 4, 2), (1, 2, 1))      # sixteenths of a cell's count that go to it and its neighbours
WHOLE = 16


def axis(c: Column, low: float, span: float, depth: int) -> Column:
    """Column or row of a coordinate at zoom ``depth``; what lies off the globe belongs to the outermost cells."""
    at = F.floor((c - F.lit(low)) / F.lit(span) * F.lit(float(2 ** depth))).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(at, F.lit(2 ** depth - 1).cast("long")))


def morton(x: Column, y: Column, depth: int) -> Column:
    """Bits of ``x`` at even places and of ``y`` at odd ones."""
    bit = lambda c, i: F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long")), 2 * i)
    return reduce(lambda a, b: a + b, [bit(x, i) + F.shiftleft(bit(y, i), 1) for i in range(depth)]) if depth else F.lit(0).cast("long")


def unmorton(key: Column, depth: int) -> tuple[Column, Column]:
    """Column and row of a Morton key."""
    bit = lambda i: F.shiftright(key, i).bitwiseAND(F.lit(1).cast("long"))
    part = lambda odd: reduce(lambda a, b: a + b, [F.shiftleft(bit(2 * i + odd), i) for i in range(depth)]) if depth else F.lit(0).cast("long")
    return part(0), part(1)


def cells(fixes: DataFrame, lat: str = "Latitude", lon: str = "Longitude", depth: int = DEPTH) -> DataFrame:
    """(cell, n_points) at the deepest zoom; fixes without coordinates are in no cell."""
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    there = fixes.where(y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x))
    key = morton(axis(x, -180.0, 360.0, depth), axis(y, -90.0, 180.0, depth), depth)
    return there.groupBy(key.alias("cell")).agg(F.count(F.lit(1)).alias("n_points"))


def pyramid(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(zoom, cell, n_points) for every zoom from 0 to ``depth`` from the cells at ``depth``."""
    prefix = F.call_function("shiftright", F.col("cell"), F.lit(2) * (F.lit(depth) - F.col("zoom")))
    levels = counted.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    return levels.groupBy("zoom", prefix.alias("cell")).agg(F.sum("n_points").alias("n_points"))


def spread(levels: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(zoom, x, y, n_points, density): every cell's count spread over it and its eight neighbours by ``KERNEL``.  Columns wrap around
    the globe and rows end at the poles, so nothing is lost: at each zoom densities add up to the number of fixes."""
    x, y = unmorton(F.col("cell"), depth)
    side = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("zoom"))
    at = levels.select("zoom", x.alias("x"), y.alias("y"), side.alias("side"), "n_points")
    shares = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).cast("long").alias("w"))
                       for dy, row in zip((-1, 0, 1), KERNEL) for dx, w in zip((-1, 0, 1), row)])
    sent = at.withColumn("s", F.explode(shares)).select(
        "zoom", F.pmod(F.col("x") + F.col("s.dx"), F.col("side")).alias("x"), F.greatest(F.lit(0).cast("long"), F.least(F.col("y") + F.col("s.dy"), F.col("side") - 1)).alias("y"),
        (F.col("s.w") * F.col("n_points")).alias("share"), F.when((F.col("s.dx") == 0) & (F.col("s.dy") == 0), F.col("n_points")).otherwise(F.lit(0)).alias("own"))
    return sent.groupBy("zoom", "x", "y").agg(F.sum("own").alias("n_points"), (F.sum("share") / F.lit(float(WHOLE))).alias("density"))


def density_pyramid(fixes: DataFrame, lat: str = "Latitude", lon: str = "Longitude", depth: int = DEPTH) -> DataFrame:
    """AGG-25 by zoom: zoom, cell, n_points, density and the cell's middle, for each cell that holds a fix or neighbours one that does."""
    s = spread(pyramid(cells(fixes, lat, lon, depth), depth), depth)
    side = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("zoom"))
    return s.select("zoom", morton(F.col("x"), F.col("y"), depth).alias("cell"), "n_points", "density",
                    ((F.col("y") + F.lit(0.5)) / side * F.lit(180.0) - F.lit(90.0)).alias("lat"), ((F.col("x") + F.lit(0.5)) / side * F.lit(360.0) - F.lit(180.0)).alias("lon"))
