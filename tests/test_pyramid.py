"""Density by zoom level (AGG-25)."""
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from movegrid.operators import pyramid

SCHEMA = "Latitude double, Longitude double"


def points(seed, n=500):
    r = random.Random(seed)
    out = [(50 + r.gauss(0, 3), 2 + r.gauss(0, 5)) for _ in range(n)]
    return out + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (91.0, 190.0), (None, 1.0), (1.0, float("nan")), (89.99, 179.99), (89.99, -179.99)] + [(10.0, 10.0)] * 50


def brute(data, depth):
    out = {}
    for z in range(depth + 1):
        side, n, d = 1 << z, Counter(), Counter()
        for y, x in data:
            if None not in (y, x) and y == y and x == x:
                cut = lambda v, low, span: max(0, min(math.floor((v - low) / span * 2 ** depth), 2 ** depth - 1)) >> (depth - z)
                n[cut(x, -180, 360), cut(y, -90, 180)] += 1
        for (x, y), k in n.items():
            for dx in (-1, 0, 1):
                for dy in (-1, 0, 1):
                    d[(x + dx) % side, max(0, min(side - 1, y + dy))] += k * (2 - abs(dx)) * (2 - abs(dy)) / 16
        out |= {(z, *c): (n[c], v) for c, v in d.items()}
    return out


def test_every_level_equals_counting(spark):
    data, depth = points(1), 7
    got = pyramid.spread(pyramid.pyramid(pyramid.cells(spark.createDataFrame(data, SCHEMA), depth=depth), depth), depth).collect()
    assert {(r.zoom, r.x, r.y): (r.n_points, r.density) for r in got} == brute(data, depth)


def test_levels_add_up_to_the_fixes_at_any_depth(spark):
    data = points(2)
    for depth in (0, 1, 16):
        df = pyramid.density_pyramid(spark.createDataFrame(data, SCHEMA), depth=depth)
        sums = {r.zoom: (r.n, r.d) for r in df.groupBy("zoom").agg(F.sum("n_points").alias("n"), F.sum("density").alias("d")).collect()}
        assert sums == {z: (len(data) - 2, len(data) - 2) for z in range(depth + 1)}
        assert df.groupBy("zoom", "cell").count().where("count > 1").count() == 0


def test_morton_keys_are_prefixes(spark):
    df = spark.createDataFrame([(i * 7919 % 4096, i * 104729 % 4096) for i in range(200)], "x long, y long")
    key = pyramid.morton(F.col("x"), F.col("y"), 12)
    parent = pyramid.morton(F.shiftright("x", 3), F.shiftright("y", 3), 9)
    x, y = pyramid.unmorton(F.col("k"), 12)
    back = df.withColumn("k", key).select("x", "y", x.alias("bx"), y.alias("by"), (F.shiftright("k", 6) == parent).alias("p")).collect()
    assert all(r.p and (r.x, r.y) == (r.bx, r.by) for r in back)


def test_empty(spark):
    assert pyramid.density_pyramid(spark.createDataFrame([], SCHEMA)).count() == 0
