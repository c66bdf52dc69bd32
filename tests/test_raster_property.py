"""Property test: raster allocation equals an exact-arithmetic brute force over the area bounds."""
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from movegrid.operators import raster
from movegrid.params import AREA_BOUNDS

CODES = [a[0] for a in AREA_BOUNDS] + [2, 5]          # two codes without bounds


def brute(totals, res):
    """Cells (lat_idx, lon_idx) -> summed catch, with exact index arithmetic and wrapping."""
    r = Fraction(res)
    n_lat, n_lon = int(Fraction(180) / r) + 1, int(Fraction(360) / r) + 1
    bounds = {c: (Fraction(a), Fraction(b), Fraction(d), Fraction(e)) for c, _, a, b, d, e in AREA_BOUNDS}
    grid = {}
    for code, _period, value in totals:
        if code not in bounds:
            continue
        la, lb, oa, ob = bounds[code]
        lats = [i for i in range(n_lat) if la <= -90 + i * r <= lb]
        if oa <= ob:
            lons = [j for j in range(n_lon) if oa <= -180 + j * r <= ob]
        else:
            lons = [j for j in range(n_lon) if -180 + j * r >= oa or -180 + j * r <= ob]
        if lats and lons:
            each = value / (len(lats) * len(lons))
            for i in lats:
                for j in lons:
                    grid[(i, j)] = grid.get((i, j), 0.0) + each
    return grid


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(CODES), st.integers(2000, 2002), st.integers(1, 10_000)),
                min_size=1, max_size=6),
       st.sampled_from([5.0, 10.0, 2.5]))
def test_grid_equals_brute_force(spark, totals, res):
    rows = [(c, p, float(v)) for c, p, v in totals]
    df = spark.createDataFrame(rows, "area_code int, period int, value double")
    got = {(r.lat_idx, r.lon_idx): r.catch for r in raster.grid(df, raster.area_bounds(spark), res).collect()}
    want = brute(rows, res)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert abs(got[k] - v) <= 1e-9 * max(1.0, abs(v))
    allocated = sum(v for c, _, v in rows if c in {a[0] for a in AREA_BOUNDS})
    total = raster.grid(df, raster.area_bounds(spark), res).agg(F.sum("catch")).first()[0] or 0.0
    assert abs(total - allocated) <= 1e-6 * max(1.0, allocated)
