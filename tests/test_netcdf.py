"""NetCDF classic files: format versions, ranges, decoding, filters, damaged files (SRC-3..5)."""
import datetime as dt
import io
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from movegrid.sources import grids as grid_src
from movegrid.sources import netcdf as nc

DAY = 86400 * 10 ** 6
RNG = np.random.default_rng(4)
LAT, LON = [50.0 + 0.5 * i for i in range(6)], [1.0 + 0.25 * i for i in range(7)]


def grid(steps=10, seed=1):
    values = np.random.default_rng(seed).normal(size=(steps, 6, 7))
    values[0, 1, 2] = np.nan
    return values


def save(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def filed(values, version=2):
    times = [i * DAY for i in range(len(values))]
    return nc.encode_file([("acartia_abundance", times, LAT, LON, values), ("temperature", times, LAT, LON, values + 1)], version)


def hand_made(version, variables, dims, records, attrs=None):
    """A file put together from (name, dimension ids, type number, attributes, array) with no help from the library."""
    big = version == 5
    count = lambda n: struct.pack(">q" if big else ">i", n)
    text = lambda s: count(len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    pad = lambda b: b + b"\0" * (-len(b) % 4)

    def attributes(some):
        out = struct.pack(">i", 12 if some else 0) + count(len(some))
        for key, (kind, value) in some.items():
            raw = value.encode() if kind == 2 else np.asarray(value, nc.TYPES[kind]).tobytes()
            out += text(key) + struct.pack(">i", kind) + count(len(raw) // np.dtype(nc.TYPES[kind]).itemsize) + pad(raw)
        return out

    def head(begins):
        out = b"CDF" + bytes([version]) + (count(records) if records is not None else b"\xff" * (8 if big else 4))
        out += struct.pack(">i", 10) + count(len(dims)) + b"".join(text(n) + count(k) for n, k in dims) + attributes(attrs or {})
        out += struct.pack(">i", 11) + count(len(variables))
        for (name, ids, kind, extra, _), begin in zip(variables, begins):
            out += text(name) + count(len(ids)) + b"".join(map(count, ids)) + attributes(extra) + struct.pack(">i", kind) + count(0)
            out += struct.pack(">i" if version == 1 else ">q", begin)
        return out

    moving = [bool(v[1]) and dims[v[1][0]][1] == 0 for v in variables]
    raws = [np.asarray(v[4], nc.TYPES[v[2]]) for v in variables]
    lone = sum(moving) == 1
    begins, at = [0] * len(variables), len(head([0] * len(variables)))
    body = b""
    for i, raw in enumerate(raws):
        if not moving[i]:
            begins[i] = at + len(body)
            body += pad(raw.tobytes())
    at += len(body)
    n = len(raws[moving.index(True)]) if any(moving) else 0
    per = [(raw[:1].tobytes() if lone else pad(raw[:1].tobytes())) if m else b"" for raw, m in zip(raws, moving)]
    for i, m in enumerate(moving):
        if m:
            begins[i] = at
            at += len(per[i])
    for k in range(n):
        for raw, m in zip(raws, moving):
            if m:
                body += raw[k:k + 1].tobytes() if lone else pad(raw[k:k + 1].tobytes())
    return head(begins) + body


@pytest.mark.parametrize("version", [1, 2, 5])
def test_written_files_come_back_in_many_ranges(spark, tmpdir_path, version):
    values = grid()
    save(tmpdir_path, "deep/er/one.nc", filed(values, version))
    slabs = nc.read_slabs(spark, f"file://{tmpdir_path}", cells=84)
    assert slabs.count() == 10 and slabs.rdd.getNumPartitions() > 1
    rows = {(r.variable, r.time, r.latitude, r.longitude): r.value for r in grid_src.explode_slabs(slabs).collect()}
    want = {}
    for name, add in (("acartia_abundance", 0), ("temperature", 1)):
        for (t, y, x), v in np.ndenumerate(values):
            want[name, dt.datetime(1970, 1, 1) + dt.timedelta(days=t), LAT[y], LON[x]] = None if np.isnan(v) else v + add
    assert rows == want
    wide = grid_src.slabs_to_wide(slabs, ["acartia_abundance", "temperature"])
    assert wide.count() == values.size - 1


def test_source_pushes_filters_into_ranges(spark, tmpdir_path):
    path = save(tmpdir_path, "one.nc", filed(grid()))
    nc.register(spark)
    cells = spark.read.format("netcdf").option("cells", 42).load(tmpdir_path)
    assert cells.rdd.getNumPartitions() == 20 and cells.count() == 840
    some = cells.where((F.col("variable") == "temperature") & (F.col("time") >= F.lit(dt.datetime(1970, 1, 3))) & (F.col("time") <= F.lit(dt.datetime(1970, 1, 5)))
                       & F.col("latitude").between(51, 52))
    assert some.rdd.getNumPartitions() == 2 and some.count()     # two steps of three rows, then one
    assert some.count() == 3 * 3 * 7
    reader = nc.NetcdfReader({"path": path, "cells": "42"})
    assert list(reader.pushFilters([nc.ds.GreaterThan(("time",), dt.datetime(1970, 1, 8)), nc.ds.In(("variable",), ("temperature", "x")), nc.ds.LessThan(("latitude",), 51.2)]))
    parts = reader.partitions()
    assert [p.cut for p in parts] == [(7, 9, 0, 3), (9, 10, 0, 3)] and {p.variable for p in parts} == {"temperature"}
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 3 * 3 * 7
    none = cells.where(F.col("latitude") > 60)
    assert none.count() == 0


def test_only_the_needed_bytes_are_read():
    data, reads = filed(grid(100)), []

    class Counting(io.BytesIO):
        def read(self, n=-1):
            out = super().read(n)
            reads.append(len(out))
            return out

    f = Counting(data)
    held = nc.read_header(f, len(data))
    reads.clear()
    got = nc.read_block(f, held["temperature"], 40, 43, 2, 4)
    assert sum(reads) == 3 * 2 * 7 * 8 and np.array_equal(got, grid(100)[40:43, 2:4] + 1)


def test_decoding_conventions(spark, tmpdir_path):
    raw = np.array([[[1, 2], [-99, 4]], [[5, -7, ], [7, 8]], [[9, 10], [11, 12]]])
    data = hand_made(1, [
        ("Time", (0,), 4, {"units": (2, "hours since 2021-08-01 06:00:00 +02:00"), "calendar": (2, "gregorian")}, [0, 24, 36]),
        ("latitude", (1,), 5, {}, [50.5, 51.5]),
        ("temperature", (0, 1, 2), 3, {"_FillValue": (3, [-99]), "missing_value": (3, [-7]), "scale_factor": (6, [0.5]), "add_offset": (5, [10.0])}, raw),
        ("note", (1,), 2, {}, np.array([b"a", b"b"]))],
        [("Time", 0), ("latitude", 2), ("lon_index", 2)], 3)
    save(tmpdir_path, "c.nc", data)
    rows = {(r.time, r.latitude, r.longitude): r.value for r in grid_src.explode_slabs(nc.read_slabs(spark, tmpdir_path)).collect()}
    start = dt.datetime(2021, 8, 1, 4)
    want = {}
    for (t, y, x), v in np.ndenumerate(raw):
        want[start + dt.timedelta(hours=[0, 24, 36][t]), [50.5, 51.5][y], float(x)] = None if v in (-99, -7) else v * 0.5 + 10
    assert rows == want


def test_levels_other_axis_orders_unsigned_streams_and_a_lone_record_variable(spark, tmpdir_path):
    salt = np.arange(24).reshape(2, 3, 2, 2) * 10          # lat, depth, time, lon
    data = hand_made(5, [("salinity", (0, 1, 2, 3), 10, {}, salt), ("time", (2,), 6, {"units": (2, "days since 2000-01-01")}, [0.5, 1.25])],
                     [("lat", 2), ("depth", 3), ("time", 2), ("lon", 2)], 0)
    save(tmpdir_path, "levels/a.nc", data)
    slabs = nc.read_slabs(spark, f"{tmpdir_path}/levels", cells=5)
    rows = {(r.level, r.time, r.lat, r.lon): r.values for r in slabs.selectExpr("level", "time[0] time", "lat[0] lat", "lon[0] lon", "values").collect()}
    assert slabs.count() == 6 and {k[0] for k in rows} == {0.0, 1.0, 2.0}
    wide = {(r.level, r.time, r.latitude, r.longitude): r.salinity for r in grid_src.slabs_to_wide(slabs, ["salinity"]).collect()}
    times = [dt.datetime(2000, 1, 1, 12), dt.datetime(2000, 1, 2, 6)]
    assert wide == {(float(d), times[t], float(y), float(x)): float(v) for (y, d, t, x), v in np.ndenumerate(salt)}
    bytes_ = np.array([[1, 2, 255], [3, 128, 5], [7, 8, 9], [0, 1, 2], [3, 3, 3]], np.uint8).view(np.int8)
    for records in (5, None):                               # a lone record variable is not padded; a stream's records are counted
        data = hand_made(2, [("oxygen", (0, 1), 1, {"_Unsigned": (2, "true")}, bytes_)], [("time", 0), ("lat", 3)], records)
        got = nc.read_header(io.BytesIO(data), len(data))["oxygen"]
        assert got.shape == (5, 3) and np.array_equal(nc.decoded(got, nc.read_block(io.BytesIO(data), got, 0, 5)), bytes_.view(np.uint8))


def test_damaged_and_foreign_files_are_named(spark, tmpdir_path):
    whole = filed(grid())
    for name, data in {"ok.nc": whole, "cut.nc": whole[:-2000], "head.nc": whole[:200], "empty.nc": b"", "hdf.nc4": b"\x89HDF\r\n\x1a\n" + b"\0" * 100,
                       "text.nc": b"not a grid at all", "other.nc": hand_made(2, [("wind", (0,), 6, {}, [1.0])], [("lat", 1)], 0),
                       "norows.nc": filed(np.zeros((0, 6, 7)))}.items():
        save(tmpdir_path, name, data)
    planned = nc.plan(spark.createDataFrame([(f"{tmpdir_path}/{n}",) for n in os.listdir(tmpdir_path)] + [(f"{tmpdir_path}/gone.nc",)], "path string"))
    got = {r.path.rsplit("/", 1)[1]: r.status for r in nc.status(planned).collect()}
    assert got == {"ok.nc": "ok", "cut.nc": "partial", "head.nc": "unreadable", "empty.nc": "unreadable", "hdf.nc4": "unreadable",
                   "text.nc": "unreadable", "other.nc": "skipped", "norows.nc": "ok", "gone.nc": "unreadable"}
    slabs = nc.read_slabs(spark, tmpdir_path, cells=42)
    by = {r.file_source: r.n for r in slabs.groupBy("file_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by["ok.nc"] == 20 and 0 < by["cut.nc"] < 20 and set(by) == {"ok.nc", "cut.nc"}
    assert nc.read_slabs(spark, f"{tmpdir_path}/nowhere").count() == 0


def test_unknown_calendars_are_not_guessed():
    var = nc.Variable("time", ("time",), (1,), np.dtype(">f8"), 0, 8, {"units": "days since 2000-01-01", "calendar": "360_day"})
    with pytest.raises(ValueError):
        nc.micros_since_epoch(var, np.array([1.0]))
    var.attrs = {"units": "m"}
    assert nc.micros_since_epoch(var, np.array([1.0])) is None


def test_many_files_are_few_partitions(spark, tmpdir_path):
    """Beyond ``FILES`` files a partition is a group of files: no task per range, no header read while planning, the same cells."""
    data, n = filed(grid(4)), 3 * nc.FILES
    for i in range(n):
        save(tmpdir_path, f"{i:03d}.nc", data)
    nc.register(spark)
    cells = spark.read.format("netcdf").option("cells", 42).load(tmpdir_path)
    some = cells.where((F.col("variable") == "temperature") & F.col("latitude").between(51, 52) & (F.col("time") >= F.lit(dt.datetime(1970, 1, 3))))
    assert cells.rdd.getNumPartitions() <= nc.FILES + 1 and cells.count() == n * 2 * 4 * 6 * 7
    one = {(r.time, r.latitude, r.longitude, r.value) for r in some.where("file_source = '000.nc'").collect()}
    assert len(one) == 2 * 3 * 7 and some.count() == n * len(one) and some.select("file_source").distinct().count() == n
    reader = nc.NetcdfReader({"path": tmpdir_path, "cells": "42"})
    assert {type(p) for p in reader.partitions()} == {nc.Files}
    assert sorted(f for p in reader.partitions() for f in p.paths) == [f for f, _ in reader.files()]
    assert nc.read_slabs(spark, tmpdir_path, cells=42).rdd.getNumPartitions() <= -(-n * 8 // nc.HEADERS)
