"""Points in areas through the quadtree cover: against plain comparisons (JN-5, FIL-13)."""
import random

import pytest
from pyspark.sql import functions as F

from movegrid.operators import areas, raster

NAN = float("nan")
POINT = "n long, Latitude double, Longitude double"
BOX = "area string, lat_min double, lat_max double, lon_min double, lon_max double"


def inside(y, x, a, wrap=True):
    _, y0, y1, x0, x1 = a
    if any(v is None or v != v for v in (y, x, y0, y1, x0, x1)) or not y0 <= y <= y1:
        return False
    return x0 <= x <= x1 if x0 <= x1 else wrap and (x0 <= x <= 180 or -180 <= x <= x1)


def made(seed, n=400, m=120):
    r = random.Random(seed)
    near = lambda: (50 + r.gauss(0, 1), 2 + r.gauss(0, 1))
    points = [(i, *(near() if r.random() < .7 else (r.uniform(-95, 95), r.uniform(-190, 190)))) for i in range(n)]
    points += [(n, None, 1.0), (n + 1, 1.0, NAN), (n + 2, 90.0, 180.0), (n + 3, -90.0, -180.0), (n + 4, 50.5, 2.25), (n + 4, 50.5, 2.25)]
    out = []
    for i in range(m):
        y, x = near()
        side = 10 ** r.uniform(-4, 2)
        out.append((f"a{i}", y, y + side, x, x + side * r.uniform(.01, 3)))
    out += [("globe", -90.0, 90.0, -180.0, 180.0), ("over", -80.0, 80.0, 170.0, -170.0), ("down", 60.0, 50.0, 0.0, 9.0), ("none", None, 1.0, 0.0, 1.0),
            ("nan", NAN, 1.0, 0.0, 1.0), ("spot", 50.5, 50.5, 2.25, 2.25), ("edge", 50.5, 51.0, 2.25, 3.0), ("twin", 50.0, 51.0, 2.0, 3.0), ("twin", 50.0, 51.0, 2.0, 3.0),
            ("beyond", 80.0, 120.0, 100.0, 200.0)]
    return points, out


@pytest.mark.parametrize("wrap", [True, False])
def test_equals_plain_comparison(spark, wrap):
    points, boxes = made(1)
    got = sorted((r.n, r.area) for r in areas.locate(spark.createDataFrame(points, POINT), spark.createDataFrame(boxes, BOX), ["area"], wrap_antimeridian=wrap).collect())
    assert got == sorted((n, a[0]) for n, y, x in points for a in boxes if inside(y, x, a, wrap))


def test_covers_are_bounded_and_join_is_an_equi_join(spark):
    _, boxes = made(2)
    plain = areas.boxes(spark.createDataFrame(boxes, BOX))
    sizes = areas.cover(plain).groupBy("area", "lat_min", "lon_min", "lat_max", "lon_max").count()
    assert sizes.where("area <> 'twin'").agg(F.max("count")).first()[0] <= (areas.SIDE + 1) ** 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = areas.locate(spark.createDataFrame(made(2)[0], POINT), spark.createDataFrame(boxes, BOX), ["area"])
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def ray(ring, y, x):
    odd = False
    for (ay, ax), (by, bx) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
            odd = not odd
    return odd


def test_polygons(spark):
    r = random.Random(3)
    points, _ = made(4)
    rings = []
    for i in range(40):
        y, x, size = 50 + r.gauss(0, 1), 2 + r.gauss(0, 1), 10 ** r.uniform(-1, 1)
        rings.append((f"p{i}", [(y + size * r.uniform(-1, 1), x + size * r.uniform(-1, 1)) for _ in range(r.randint(3, 9))]))
    rings += [("line", [(50.0, 1.0), (51.0, 2.0)]), ("empty", []), ("missing", None)]
    df = spark.createDataFrame(rings, "area string, ring array<struct<lat: double, lon: double>>")
    got = sorted((q.n, q.area) for q in areas.locate(spark.createDataFrame(points, POINT), df, ["area"], ring="ring").collect())
    want = sorted((n, name) for n, y, x in points if None not in (y, x) and x == x for name, ring in rings if ring and len(ring) > 2 and ray(ring, y, x))
    assert got == want and want


def test_empty_sides_and_clashing_names(spark):
    p, a = spark.createDataFrame(made(1)[0], POINT), spark.createDataFrame(made(1)[1], BOX)
    assert areas.locate(p.limit(0), a, ["area"]).count() == areas.locate(p, a.limit(0), ["area"]).count() == 0
    with pytest.raises(ValueError):
        areas.locate(p.withColumn("area", F.lit("x")), a, ["area"])


def test_raster_allocation_has_no_hint(spark):
    totals = spark.createDataFrame([(27, 2020, 5.0)], "area_code int, period int, value double")
    plan = raster.cells(totals, raster.area_bounds(spark))._jdf.queryExecution().logical().toString()
    assert "Hint" not in plan


def test_counts_without_a_row_per_point_and_area(spark, monkeypatch):
    """Blocks of shapes and points, dealt by id and by shape, count what ``locate`` lists; there is no join of points with areas."""
    r, (points, boxes) = random.Random(5), made(5, n=3000, m=200)
    points = [(n if n % 50 else None, y, x, None if n % 40 == 0 else f"t{n * 7919 % 3000:04d}") for n, y, x in ((r.randint(0, 300), y, x) for _, y, x in points)]
    fixes = spark.createDataFrame(points, "n long, Latitude double, Longitude double, at string")
    # areas of several boxes, some equal or over each other, one of more than are looked up together, one without a name
    boxes += [("many", 45 + i / 10, 46 + i / 10, 0.0, 4.0) for i in range(areas.PIECES + 5)] + [(None, 49.0, 51.0, 1.0, 3.0), (None, 50.0, 52.0, 179.0, 2.0), ("a0", 40.0, 60.0, -10.0, 20.0)]
    rings = [(f"p{i % 30}", [(50 + r.gauss(0, 1) + 3 * r.uniform(-1, 1), 2 + r.gauss(0, 1) + 3 * r.uniform(-1, 1)) for _ in range(r.randint(2, 9))]) for i in range(40)]
    rings += [("p1", rings[1][1]), ("empty", []), ("missing", None)]
    both = [(spark.createDataFrame(boxes, BOX), {}), (spark.createDataFrame(boxes, BOX), {"wrap_antimeridian": False}),
            (spark.createDataFrame(rings, "area string, ring array<struct<lat: double, lon: double>>"), {"ring": "ring"})]
    for held, kw in both:
        want = sorted(tuple(w) for w in areas.locate(fixes, held, ["area"], **kw).groupBy("area").agg(
            F.count(F.lit(1)), F.count_distinct("n"), F.min("at"), F.max("at")).fillna("", "area").collect())
        for sizes in ((100_000, 10_000), (90, 17)):
            monkeypatch.setattr(areas, "POINTS", sizes[0])
            monkeypatch.setattr(areas, "SHAPES", sizes[1])
            got = areas.count_in_areas(fixes, held, "area", id="n", ts="at", **kw)
            assert sorted(tuple(g) for g in got.fillna("", "area").collect()) == want and len(want) > 20
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert "FlatMapCoGroupsInArrow" in plan
