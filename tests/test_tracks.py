"""Track operators on hand-computed micro-fixtures (D1, D5, D17, D18, D24, WIN-3) and invariants."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from movegrid.operators import tracks
from movegrid.plans import track_queries as tq
from movegrid.sources.standins import track_points
from tests.conftest import SF_SMALL

SCHEMA = "id long, Date timestamp_ntz, Latitude double, Longitude double, row_order long"


def T(day, hour=0):
    return dt.datetime(2021, 8, day, hour)


def fixes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("chunk_days", [None, 1 / 24, 1, 7])
def test_metrics_before_cleaning_outlier_influences_successor(spark, chunk_days):
    # id 1: good, outlier, good.  The outlier is removed by the speed cap but its
    # successor's step is still measured from the outlier (D1).
    df = fixes(spark, [(1, T(1), 50.0, 2.0, 1), (1, T(2), 65.0, 2.0, 2), (1, T(3), 50.5, 2.0, 3)])
    p = {r.row_order: r for r in tracks.process(df, chunk_days=chunk_days).collect()}
    assert p[1].distance is None and p[1].speed is None        # first fix: no predecessor
    assert p[2].distance == pytest.approx(15.0)
    assert p[3].lat_diff == pytest.approx(-14.5)               # measured from the outlier
    assert p[3].cumulative_distance == pytest.approx(29.5)
    assert p[2].center_lat == pytest.approx((50 + 65 + 50.5) / 3)  # centroid includes the outlier (D27)
    kept = tracks.clean(tracks.process(df, chunk_days=chunk_days)).collect()
    assert [r.row_order for r in kept] == []                   # 15 and 14.5 deg/day both exceed 10


def test_first_fix_always_removed_and_zero_time_gives_missing_speed(spark):
    df = fixes(spark, [(1, T(1), 50.0, 2.0, 1), (1, T(1), 50.1, 2.0, 2), (1, T(2), 50.2, 2.0, 3)])
    p = {r.row_order: r for r in tracks.process(df).collect()}
    assert p[2].time_diff == 0.0 and p[2].speed is None        # replace(0, nan)
    kept = sorted(r.row_order for r in tracks.clean(tracks.process(df)).collect())
    assert kept == [3]


def test_ties_follow_source_order(spark):
    df = fixes(spark, [(1, T(1), 50.0, 2.0, 20), (1, T(1), 51.0, 2.0, 10), (1, T(2), 52.0, 2.0, 30)])
    p = {r.row_order: r for r in tracks.process(df).collect()}
    assert p[10].lat_diff is None                               # row 10 precedes row 20 (D18)
    assert p[20].lat_diff == pytest.approx(-1.0)


def test_null_id_dropped_null_date_last_null_latitude_mid_track(spark):
    df = fixes(spark, [
        (None, T(1), 50.0, 2.0, 1),
        (2, T(1), 50.0, 2.0, 2), (2, T(2), None, 2.0, 3), (2, T(3), 50.2, 2.0, 4), (2, None, 50.3, 2.0, 5),
    ])
    p = {r.row_order: r for r in tracks.process(df, chunk_days=1).collect()}
    assert 1 not in p                                           # D24
    assert p[3].distance is None and p[3].cumulative_distance is None
    assert p[4].distance is None                                # predecessor latitude missing
    assert p[5].lat_diff == pytest.approx(0.1)                  # NULL time sorts last (D17)
    assert p[5].cumulative_distance == pytest.approx(0.1)       # the sum continues past missing steps
    assert p[5].time_diff is None


def test_chunked_equals_whole_track_windows(spark):
    tp = track_points(spark, SF_SMALL)
    cols = ["id", "row_order", "lat_diff", "lon_diff", "distance", "time_diff", "speed", "cumulative_distance",
            "center_lat", "dist_from_center"]
    a = {r.row_order: r for r in tracks.process(tp, chunk_days=None).select(cols).collect()}
    for chunk in (1, 1 / 24):
        b = {r.row_order: r for r in tracks.process(tp, chunk_days=chunk).select(cols).collect()}
        assert a.keys() == b.keys()
        for k in a:
            for c in cols:
                x, y = a[k][c], b[k][c]
                assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (k, c, x, y)


@pytest.mark.parametrize("undated", [False, True])
def test_hot_track_is_cut_below_the_target(spark, undated):
    # 3000 fixes of one id inside an hour, a third of them at one instant, or none with a time
    at = "timestamp_ntz '2021-08-01 00:00:00' + make_dt_interval(0, 0, 0, CASE WHEN row_order % 3 = 0 THEN 100 ELSE row_order END)"
    df = spark.range(1, 3001).selectExpr("id AS row_order").selectExpr(
        "1L AS id", f"{'CAST(NULL AS timestamp_ntz)' if undated else at} AS Date", "50 + row_order % 7 / 10.0D AS Latitude",
        "2 + row_order % 5 / 10.0D AS Longitude", "row_order")
    sizes = [r["count"] for r in tracks.chunked(df, heavy_rows=200).groupBy("id", "_chunk").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 3000
    cols = ["row_order", "lat_diff", "time_diff", "distance", "cumulative_distance", "center_lat"]
    a = sorted(tuple(r) for r in tracks.process(df, chunk_days=None).select(cols).collect())
    b = sorted(tuple(r) for r in tracks.process(df, heavy_rows=200).select(cols).collect())
    for x, y in zip(a, b):
        assert all((p is None and q is None) or math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9) for p, q in zip(x, y)), (x, y)


def test_cumulative_distance_is_optional(spark):
    tp = track_points(spark, SF_SMALL)
    full, short = tracks.process(tp), tracks.process(tp, cumulative=False)
    assert set(full.columns) - set(short.columns) == {"cumulative_distance"}
    cols = sorted(short.columns)
    assert sorted(map(str, full.select(cols).collect())) == sorted(map(str, short.select(cols).collect()))


def test_results_do_not_depend_on_input_partitioning(spark):
    tp = track_points(spark, SF_SMALL)
    a = sorted(tuple(r) for r in tracks.summary(tracks.clean(tracks.process(tp))).collect())
    b = sorted(tuple(r) for r in tracks.summary(tracks.clean(tracks.process(tp.repartition(7, "row_order")))).collect())
    assert a == b


def test_invariants_on_stand_in(spark):
    proc = tq.processed(spark, SF_SMALL, cumulative=True)
    acc = tracks.clean_accounting(proc).first()
    assert acc.initial_count == acc.final_count + acc.removed_count
    assert acc.removed_count == (acc.removed_missing_coordinates + acc.removed_outside_box + acc.removed_speed_cap
                                 + acc.removed_time_not_positive)
    assert acc.final_count == tracks.clean(proc).count()
    # last cumulative distance of every track equals the sum of its steps
    last = proc.groupBy("id").agg(F.max_by("cumulative_distance", F.struct("Date", "row_order")).alias("last"),
                                  F.sum("distance").alias("total"))
    for r in last.collect():
        if r.total is not None and r.last is not None:
            assert r.last == pytest.approx(r.total)


def test_missing_required_column_raises(spark):
    df = spark.createDataFrame([(1, 50.0)], "id long, Latitude double")
    with pytest.raises(ValueError):
        tracks.check_required(df)


def test_empty_totals_are_zero(spark):
    empty = spark.createDataFrame([], "distance double, speed double")
    r = tracks.totals(empty).first()
    assert r.total_distance == 0.0 and r.avg_speed is None    # D5


def test_every_kth_matches_row_number(spark):
    from movegrid.functions.ordering import with_global_index
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    idx = with_global_index(df, [F.col("k")], "i").collect()
    assert sorted((r.k, r.i) for r in idx) == [(k, k) for k in range(1000)]
    s = tracks.sampled(tracks.clean(tq.processed(spark, SF_SMALL)), 3)
    n = tracks.clean(tq.processed(spark, SF_SMALL)).count()
    assert s.count() == (n + 2) // 3


def test_process_reads_the_fixes_twice(spark):
    """Two scans whatever is asked for; no slice is heavy here, so none are spent on cuts."""
    path = "/root/testdata/sf0.001"
    from movegrid.sources.standins import track_points
    for cumulative in (True, False):
        df = tracks.process(track_points(spark, path), cumulative=cumulative)
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
        assert leaves == 2, (cumulative, leaves)
