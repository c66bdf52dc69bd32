"""Grid, feature and model operators on micro-fixtures (SET-1, SRC-3..6, FIL-6, AGG-22/23, ML-1)."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from movegrid.functions import resolve
from movegrid.operators import features, grids, model, profiles
from movegrid.sources import files
from movegrid.sources import grids as grid_src

TS = dt.datetime(2021, 8, 1)


def test_slab_explode_index_layout(spark):
    slab = spark.createDataFrame(
        [("f.nc", "temperature", [TS, TS + dt.timedelta(days=1)], [50.0, 51.0], [1.0, 2.0, 3.0],
          [float(i) for i in range(12)])],
        "file_source string, variable string, time array<timestamp_ntz>, lat array<double>, lon array<double>, "
        "values array<double>")
    rows = {(r.time.day, r.latitude, r.longitude): r.value for r in grid_src.explode_slabs(slab).collect()}
    assert len(rows) == 12
    assert rows[(1, 50.0, 1.0)] == 0.0 and rows[(1, 50.0, 3.0)] == 2.0
    assert rows[(1, 51.0, 1.0)] == 3.0 and rows[(2, 50.0, 1.0)] == 6.0 and rows[(2, 51.0, 3.0)] == 11.0


def test_wide_drops_cells_missing_a_variable_of_their_own_file(spark):
    long = spark.createDataFrame([
        ("a.nc", TS, 50.0, 1.0, "temperature", 1.0), ("a.nc", TS, 50.0, 1.0, "salinity", None),
        ("a.nc", TS, 50.0, 2.0, "temperature", 2.0), ("a.nc", TS, 50.0, 2.0, "salinity", 35.0),
        ("b.nc", TS, 50.0, 1.0, "temperature", float("nan")),
        ("c.nc", TS, 50.0, 1.0, "temperature", 4.0),
    ], "file_source string, time timestamp_ntz, latitude double, longitude double, variable string, value double")
    long = long.withColumn("value", F.when(F.isnan("value"), None).otherwise(F.col("value")))
    w = {(r.file_source, r.longitude): r for r in grid_src.to_wide(long).collect()}
    assert set(w) == {("a.nc", 2.0), ("c.nc", 1.0)}
    assert w[("c.nc", 1.0)].salinity is None            # a variable the file lacks stays NULL


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "latitude double, temperature double")
    b = spark.createDataFrame([(3.0, 4.0)], "latitude double, salinity double")
    u = grids.union_files([a, None, b])
    assert set(u.columns) == {"latitude", "temperature", "salinity"} and u.count() == 2
    assert grids.union_files([None]) is None


def test_listing_finds_nested_files(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "sub", "deep"))
    for i, name in enumerate(["a.nc", "sub/b.nc4", "sub/deep/c_interp.nc", "d.txt", "e.netcdf"]):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(b"x" * (i + 1))
    uri = f"file://{tmpdir_path}"
    found = {os.path.relpath(r.path.removeprefix("file:"), tmpdir_path): r.length for r in files.listing(spark, uri, files.GRID_PATTERN).collect()}
    assert found == {"a.nc": 1, "e.netcdf": 5, "sub/b.nc4": 2, "sub/deep/c_interp.nc": 3}
    twice = files.listing(spark, [uri, f"{uri}/sub", f"{uri}/missing"], files.GRID_PATTERN)
    assert twice.count() == 4 and twice.columns == ["path", "length", "modified"]
    assert files.listing(spark, f"{uri}/missing").count() == 0
    assert files.listing(spark, uri, files.GRID_PATTERN, recursive=False).count() == 2


def test_corrupt_grid_file_is_skipped(spark, tmpdir_path):
    good = os.path.join(tmpdir_path, "good")
    spark.createDataFrame([("f.nc", "temperature", [TS], [50.0], [1.0], [7.0])],
                          "file_source string, variable string, time array<timestamp_ntz>, lat array<double>, "
                          "lon array<double>, values array<double>").write.parquet(good)
    with open(os.path.join(good, "broken.parquet"), "wb") as fh:
        fh.write(b"not a parquet file")
    slabs = grid_src.read_array_slabs(spark, good)
    assert grid_src.explode_slabs(slabs).count() == 1
    other = os.path.join(good, "sub")
    spark.createDataFrame([("g.nc", "u_wind", [TS], [50.0], [1.0], [7.0])], grid_src.SLAB_SCHEMA).coalesce(1).write.parquet(other)
    status = {(r.status, r.error) for r in grid_src.slab_status(spark, good, glob="*.parquet").collect() if r.n_slabs or r.error != "no slab could be read" or "broken" in r.path}
    assert status >= {("ok", None), ("skipped", "no plankton or environmental variable"), ("unreadable", "no slab could be read")}
    assert grid_src.slab_variables(slabs) == ["temperature"]


@pytest.mark.parametrize("column", ["values", "variable"])
def test_damaged_part_of_a_grid_file_is_reported(spark, tmpdir_path, column):
    import pyarrow as pa
    import pyarrow.parquet as pq
    names = ["temperature", "salinity", "u_wind", "acartia", "nitrate", "temperature"]
    rows = pa.table({"file_source": ["f.nc"] * 6, "variable": names, "time": pa.array([[TS]] * 6, pa.list_(pa.timestamp("us"))), "lat": [[50.0]] * 6,
                     "lon": [[1.0]] * 6, "values": [[float(i)] for i in range(6)]})
    for name in ("whole", "part", "none"):
        pq.write_table(rows, os.path.join(tmpdir_path, f"{name}.parquet"), row_group_size=2, compression="NONE", use_dictionary=False)
    for name, groups in (("part", [1]), ("none", [0, 1, 2])):
        path = os.path.join(tmpdir_path, f"{name}.parquet")
        for g in groups:
            group = pq.ParquetFile(path).metadata.row_group(g)
            chunk = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema.split(".")[0] == column)
            with open(path, "r+b") as fh:
                fh.seek(chunk.data_page_offset)
                fh.write(b"\xff" * 16)
    got = {os.path.basename(r.path): (r.status, r.error, r.n_slabs) for r in grid_src.slab_status(spark, tmpdir_path, glob="*.parquet").collect()}
    n = grid_src.read_array_slabs(spark, tmpdir_path + "/part.parquet").collect()
    assert 0 < len(n) < 6
    assert got["whole.parquet"] == ("ok", None, 5) and got["none.parquet"] == ("unreadable", "no slab could be read", 0)
    assert got["part.parquet"][:2] == ("partial", f"{len(n)} of 6 rows could be read")


def test_tiled_wide_equals_long_and_pivot(spark):
    days = [TS, TS + dt.timedelta(days=1)]
    slabs = spark.createDataFrame([
        ("a.nc", "temperature", days, [50.0, 51.0], [1.0, 2.0, 3.0], [float(i) if i != 4 else float("nan") for i in range(12)]),
        ("a.nc", "salinity", days, [50.0, 51.0], [1.0, 2.0, 3.0], [float(30 + i) for i in range(12)]),
        ("b.nc", "salinity", days[:1], [50.0], [1.0, 2.0], [1.0, float("nan")]),
    ], grid_src.SLAB_SCHEMA)
    names = ["temperature", "salinity"]
    a = grid_src.slabs_to_wide(slabs, names)
    b = grid_src.to_wide(grid_src.explode_slabs(slabs), names)
    assert sorted(map(tuple, a.select(b.columns).collect()), key=str) == sorted(map(tuple, b.collect()), key=str) and a.count() == 12


def test_sample_grid_shape(spark):
    g = grid_src.sample_grid(spark)
    assert g.count() == 24400
    r = g.agg(F.countDistinct("latitude"), F.countDistinct("longitude"), F.countDistinct("time"),
              F.max("acartia_abundance")).first()
    assert tuple(r)[:3] == (20, 20, 61)
    assert r[3] <= 0.0          # the seasonal factor is negative for all of Aug-Sep (D19)


def test_resolvers():
    cols = ["time", "latitude", "longitude", "acartia_abundance", "Temperature_surface", "salt", "file_source"]
    assert resolve.first_containing(cols, "lat") == "latitude"
    assert resolve.variable_columns(cols) == ["acartia_abundance", "Temperature_surface", "salt"]
    assert resolve.intersect_ordered(["b", "a", "c"], ["c", "b"]) == ["b", "c"]


def test_correlation_constant_column_and_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0)],
                               "a double, b double, c double")
    r = {(x.var_a, x.var_b): x for x in features.correlation(df, ["a", "b", "c"]).collect()}
    assert r[("b", "a")].corr == pytest.approx(1.0) and r[("b", "a")].n == 3
    assert r[("c", "a")].corr is None and set(r) == {("b", "a"), ("c", "a"), ("c", "b")}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    h = {r.bin: r.n for r in profiles.histogram(df, "v", 20).collect()}
    assert len(h) == 20 and h[0] == 1 and h[2] == 1 and h[19] == 1 and sum(h.values()) == 3
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h2 = {r.bin: (r.n, r.bin_lo) for r in profiles.histogram(same, "v", 20).collect()}
    assert h2[10][0] == 2 and h2[0][1] == pytest.approx(2.5)


def test_split_exact_size_and_disjoint(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "k")
    s = features.split(df, features.split_order(F.col("k"), 42), 0.2)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"test": 21, "train": 80}
    assert s.select("k").distinct().count() == 101


def test_linear_model_recovers_plane(spark):
    rows = [(i, j, float(i), float(j), 2.0 * i + 3.0 * j + 1.0) for i in range(10) for j in range(10)]
    df = spark.createDataFrame(rows, "lat_key long, lon_key long, x double, y double, speed double")
    tm = model.train(df, "linear", features=["x", "y"])
    m = tm.metrics().first()
    assert m.r2 == pytest.approx(1.0, abs=1e-6) and m.rmse < 1e-6
    assert tm.train.count() + tm.test.count() == 100
    with pytest.raises(ValueError):
        model.estimator("gradient_boosting")


def test_exact_medians_match_python(spark):
    import random
    import statistics

    from movegrid.functions.ordering import exact_medians
    rnd = random.Random(7)
    rows = [(rnd.choice([None, rnd.random() * 10, float(rnd.randint(0, 5))]), rnd.choice([None, rnd.gauss(0, 1)]),
             None) for _ in range(301)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    r = exact_medians(df, ["a", "b", "c"]).first()
    for i, c in enumerate("ab"):
        assert r[f"_med_{c}"] == pytest.approx(statistics.median([x[i] for x in rows if x[i] is not None]))
    assert r["_med_c"] is None


def test_grid_calendar_parses_text_times_without_zone(spark):
    from movegrid.functions.temporal import with_grid_calendar
    df = spark.createDataFrame([("2021-08-01 10:00:00",), ("junk",), ("2021-12-31",)], "time string")
    rows = [tuple(r) for r in with_grid_calendar(df, "time").collect()]
    assert rows[0][1:] == (2021, 8, 213, "Summer")
    assert rows[1] == (None, None, None, None, None)
    assert rows[2][1:] == (2021, 12, 365, "Winter")
    assert dict(with_grid_calendar(df, "time").dtypes)["time"] == "timestamp_ntz"
    assert with_grid_calendar(df, None) is df


def test_cross_validation_of_few_rows(spark):
    rows = [(i, 0, float(i), 2.0 * i + 1.0) for i in range(4)]
    ddl = "lat_key long, lon_key long, x double, speed double"
    tm = model.train(spark.createDataFrame(rows, ddl), "linear", features=["x"], test_size=0.25)
    folds = model.cross_validate(tm, 5)
    assert [(f.fold, f.n) for f in folds.orderBy("fold").collect()] == [(0, 1), (1, 1), (2, 1)]
    tm.train = tm.train.limit(1)
    assert model.cross_validate(tm, 5).isEmpty() and model.cv_summary(model.cross_validate(tm, 5)).first().r2_mean is None
