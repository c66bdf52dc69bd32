"""NetCDF classic files (CDF-1, CDF-2 and CDF-5), read by ranges.

A classic file is a header and plain arrays: variables without the record dimension lie whole, one
after the other; those with it are interleaved record by record.  So any block of a variable is
found by arithmetic, and a file of any size is read by many tasks that each seek their own bytes.

* ``plan`` reads headers in parallel (a file per row of a listing) and gives a row per range of
  records of each chosen variable, or one that says why a file gives none;
* ``read_slabs`` deals these ranges to tasks and returns array-encoded slabs;
* ``NetcdfSource`` is the same as a data source of single cells, ``spark.read.format("netcdf")``, which
  takes filters on variable, time, latitude and longitude into the choice of ranges;
* ``write_files`` writes slabs as files, a task per file.

Values are decoded as the conventions say: fill and missing values are null, then scale and offset;
times count from the date in their units.  Axes are told by their names (time, lat, lon); one
more axis is the level.  A dimension without a variable of its name counts from zero.
"""
from __future__ import annotations

import re
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, datasource as ds, functions as F

from movegrid.functions import resolve
from movegrid.sources.files import GRID_PATTERN, listing, target, write_whole

# FIXED VALUES — external types of the format by number, and the tags of the header's lists
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12

CELLS = 1 << 20        # values of a range
BATCH = 1 << 16        # cells of a batch of single cells
PIECE = 1 << 16        # bytes of a header read at once
HEADERS = 32           # files, or ranges, that a task opens where there are many
FILES = 64             # files whose headers a data source reads while planning, at most
GROUP = 1 << 26        # bytes of the files of a partition, where there are more files
MICROS = {"microsecond": 1, "millisecond": 10 ** 3, "second": 10 ** 6, "sec": 10 ** 6, "s": 10 ** 6, "minute": 60 * 10 ** 6, "min": 60 * 10 ** 6,
          "hour": 3600 * 10 ** 6, "hr": 3600 * 10 ** 6, "h": 3600 * 10 ** 6, "day": 86400 * 10 ** 6, "d": 86400 * 10 ** 6, "week": 7 * 86400 * 10 ** 6}
CALENDARS = ("standard", "gregorian", "proleptic_gregorian")
AXES = ("time", "level", "lat", "lon")
SLABS = "file_source string, variable string, level double, time array<timestamp_ntz>, lat array<double>, lon array<double>, values array<double>"
CELL_ROWS = "file_source string, variable string, time timestamp_ntz, level double, latitude double, longitude double, value double"
PLAN = "path string, length long, status string, error string, variable string, lo int, hi int, inner_lo int, inner_hi int, cells long"

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks get these functions with their closures


# ---- the format ------------------------------------------------------------------------------

@dataclass
class Variable:
    name: str
    dims: tuple[str, ...]
    shape: tuple[int, ...]
    dtype: np.dtype
    begin: int
    stride: int                  # bytes from one index of the first axis to the next
    attrs: dict = field(default_factory=dict)

    @property
    def row(self) -> int:
        """Bytes of one index of the first axis."""
        return int(np.prod(self.shape[1:], dtype=np.int64)) * self.dtype.itemsize

    @property
    def end(self) -> int:
        """Where the file must reach; an empty variable needs nothing."""
        if 0 in self.shape:
            return 0
        return self.begin + (self.shape[0] - 1) * self.stride + self.row if self.shape else self.begin + self.dtype.itemsize


class Head:
    """Sequential reader of a header that fetches no more than it needs."""

    def __init__(self, f, length: int):
        self.f, self.length, self.data, self.at = f, length, b"", 0

    def take(self, n: int) -> bytes:
        if n > self.length - self.at:
            raise ValueError("header runs past the end of the file")
        while len(self.data) < self.at + n:
            more = self.f.read(max(PIECE, self.at + n - len(self.data)))
            if not more:
                raise ValueError("header runs past the end of the file")
            self.data += more
        self.at += n
        return self.data[self.at - n:self.at]


def read_header(f, length: int) -> dict[str, Variable]:
    """The variables of a file by name; ValueError for what is no classic file."""
    head = Head(f, length)
    magic = head.take(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise ValueError("not a classic NetCDF file" + (" (an HDF5 file)" if magic == b"\x89HDF" else ""))
    count_of, offset_of = (">q", 8) if magic[3] == 5 else (">i", 4), (">i", 4) if magic[3] == 1 else (">q", 8)

    def number(of=count_of) -> int:
        return struct.unpack(of[0], head.take(of[1]))[0]

    def name() -> str:
        n = number()
        return head.take(n + -n % 4)[:n].decode("utf-8")

    def items(tag: int) -> range:
        found, n = number((">i", 4)), number()
        if found not in (0, tag) or n < 0 or (found == 0 and n):
            raise ValueError("damaged header")
        return range(n)

    def attributes() -> dict:
        out = {}
        for _ in items(ATTRIBUTE):
            key, kind, n = name(), np.dtype(TYPES[number((">i", 4))]), number()
            raw = head.take(n * kind.itemsize + -(n * kind.itemsize) % 4)[:n * kind.itemsize]
            out[key] = raw.decode("utf-8", "replace").rstrip("\0") if kind == "S1" else np.frombuffer(raw, kind)
        return out

    try:
        records = number()
        dims = [(name(), number()) for _ in items(DIMENSION)]
        attributes()
        found = []
        for _ in items(VARIABLE):
            key = name()
            ids = [number() for _ in range(number())]
            attrs, kind = attributes(), np.dtype(TYPES[number((">i", 4))])
            number()                                    # stored size: may not fit, so it is reckoned
            found.append((key, ids, attrs, kind, number(offset_of)))
        of_record = [v for v in found if v[1] and dims[v[1][0]][1] == 0]
        inner = {id(v): int(np.prod([dims[d][1] for d in v[1][1:]], dtype=np.int64)) * v[3].itemsize for v in of_record}
        record = sum(n + -n % 4 for n in inner.values()) if len(of_record) != 1 else sum(inner.values())
        if records < 0:                                 # written as a stream: as many as there are
            records = (length - min(v[4] for v in of_record)) // record if of_record and record else 0
        out = {}
        for v in found:
            key, ids, attrs, kind, begin = v
            shape = tuple(dims[d][1] if dims[d][1] or k else records for k, d in enumerate(ids))
            var = Variable(key, tuple(dims[d][0] for d in ids), shape, kind, begin, 0, attrs)
            var.stride = record if id(v) in inner else var.row
            out[key] = var
        return out
    except (struct.error, KeyError, IndexError, UnicodeDecodeError, OverflowError) as e:
        raise ValueError(f"damaged header: {e}") from e


def clip(variables: dict[str, Variable], length: int) -> list[str]:
    """Leave out the records that a file of ``length`` bytes doesn't hold whole; the names of the variables that end early."""
    short = sorted(v.name for v in variables.values() if v.end > length)
    moving = [v for v in variables.values() if v.shape and v.stride != v.row or v.name in short and v.shape]
    if short and moving:
        there = {v.name: max(0, (length - v.begin - v.row) // v.stride + 1) if v.stride else 0 for v in moving}
        least = {v.dims[0]: min(there[w.name] for w in moving if w.dims[0] == v.dims[0]) for v in moving}
        for v in variables.values():
            if v.shape and v.dims[0] in least:
                v.shape = (min(v.shape[0], least[v.dims[0]]), *v.shape[1:])
    return short


def read_block(f, var: Variable, lo: int, hi: int, inner_lo: int = 0, inner_hi: int | None = None) -> np.ndarray:
    """Indices [lo, hi) of the first axis and [inner_lo, inner_hi) of the second, as stored; only these bytes are read."""
    if not var.shape:
        lo, hi, rows = 0, 1, 1
    rest = var.shape[2:]
    one = int(np.prod(rest, dtype=np.int64)) * var.dtype.itemsize
    inner_hi = (var.shape[1] if len(var.shape) > 1 else 1) if inner_hi is None else inner_hi
    if len(var.shape) < 2:
        one, inner_lo, inner_hi = var.dtype.itemsize, 0, 1
    size, parts = (inner_hi - inner_lo) * one, []
    whole = var.stride == size                          # rows follow each other: one read
    for at, n in [(lo, (hi - lo) * size)] if whole else [(i, size) for i in range(lo, hi)]:
        f.seek(var.begin + at * var.stride + inner_lo * one)
        data = f.read(n)
        if len(data) != n:
            raise EOFError(f"variable {var.name} ends early")
        parts.append(data)
    shape = (hi - lo, *((inner_hi - inner_lo,) if len(var.shape) > 1 else ()), *rest)
    return np.frombuffer(b"".join(parts), var.dtype).reshape(shape if var.shape else ())


def decoded(var: Variable, raw: np.ndarray) -> np.ndarray:
    """Doubles by the conventions; what is missing is NaN."""
    if str(var.attrs.get("_Unsigned", "")).lower() == "true" and raw.dtype.kind == "i":
        raw = raw.view(raw.dtype.str.replace("i", "u"))
    out = raw.astype(np.float64)
    for key in ("_FillValue", "missing_value"):
        for bad in np.atleast_1d(var.attrs.get(key, [])):
            if not isinstance(bad, str):
                out[raw == np.asarray(bad).astype(raw.dtype)] = np.nan
    for key, apply in (("scale_factor", np.multiply), ("add_offset", np.add)):
        if key in var.attrs and not isinstance(var.attrs[key], str):
            out = apply(out, float(var.attrs[key][0]))
    return out


def micros_since_epoch(var: Variable, values: np.ndarray) -> np.ndarray | None:
    """Times as microseconds since 1970; None if the variable doesn't count from a date.  NaN gives the least integer."""
    units = var.attrs.get("units", "")
    m = re.match(r"\s*([a-z]+?)s?\s+since\s+(-?\d{1,4})-(\d{1,2})-(\d{1,2})(?:[T ]+(\d{1,2}):(\d{1,2})(?::(\d{1,2})(\.\d+)?)?)?", units if isinstance(units, str) else "", re.I)
    if not m:
        return None
    unit = m[1].lower()
    calendar = str(var.attrs.get("calendar", "standard")).lower()
    if unit not in MICROS and f"{unit}s" not in MICROS or calendar not in CALENDARS:
        raise ValueError(f"times in {units!r} of the {calendar} calendar")
    year, month, day, hour, minute, second = (int(x or 0) for x in m.groups()[1:7])
    start = np.datetime64(f"{year:04d}-{month:02d}-{day:02d}T{hour:02d}:{minute:02d}:{second:02d}", "us").astype(np.int64)
    start += int(round(float(m[8] or 0) * 1e6))
    zone = re.search(r"([+-])(\d{1,2}):?(\d{2})?\s*$", units[m.end():])
    if zone:
        start -= (1 if zone[1] == "+" else -1) * (int(zone[2]) * 60 + int(zone[3] or 0)) * 60 * 10 ** 6
    step = MICROS.get(unit) or MICROS[f"{unit}s"]
    whole = np.where(np.isnan(values), 0, np.floor(values))
    out = start + whole.astype(np.int64) * step + np.rint(np.where(np.isnan(values), 0, values - whole) * step).astype(np.int64)
    return np.where(np.isnan(values), np.iinfo(np.int64).min, out)


# ---- what a file holds -----------------------------------------------------------------------

def axis_of(dim: str) -> str:
    low = dim.lower()
    return next((a for a in ("time", "lat", "lon") if a in low), "level")


def grid_variables(variables: dict[str, Variable], chosen: list[str] | None) -> list[Variable]:
    """Variables that are grids: numbers on at most one axis of each kind, no axis themselves.  ``chosen`` names them;
    by default the plankton and environmental ones (SEL-1, SEL-2)."""
    grids = [v for v in variables.values() if v.dtype.kind != "S" and v.dims and v.dims != (v.name,) and len({axis_of(d) for d in v.dims}) == len(v.dims)]
    names = resolve.variable_columns([v.name for v in grids]) if chosen is None else chosen
    return [v for v in grids if v.name in names]


def axis_values(f, variables: dict[str, Variable], dim: str, n: int) -> np.ndarray:
    """The axis along a dimension, decoded; times in microseconds since 1970 (all least integers, if it doesn't say since when)."""
    var = variables.get(dim)
    if var is None or var.dims != (dim,) or var.dtype.kind == "S":
        return np.full(n, np.iinfo(np.int64).min) if axis_of(dim) == "time" else np.arange(n, dtype=np.float64)
    values = decoded(var, read_block(f, var, 0, n))
    if axis_of(dim) != "time":
        return values
    times = micros_since_epoch(var, values)
    return np.full(n, np.iinfo(np.int64).min) if times is None else times


def within(values: np.ndarray, bounds: tuple) -> tuple[int, int]:
    """The smallest range of indices that holds all values in the closed bounds (None: open)."""
    lo, hi = bounds
    with np.errstate(invalid="ignore"):
        met = np.flatnonzero((values >= lo if lo is not None else True) & (values <= hi if hi is not None else True) & np.ones(len(values), bool))
    return (int(met[0]), int(met[-1]) + 1) if len(met) else (0, 0)


def ranges(f, variables: dict[str, Variable], var: Variable, bounds: dict[str, tuple], cells: int = CELLS) -> Iterator[tuple[int, int, int, int]]:
    """(lo, hi, inner_lo, inner_hi) blocks of the first two axes that hold up to ``cells`` values each (or one index of
    both), without the indices that lie outside ``bounds`` by axis."""
    spans = []
    for k, (dim, n) in enumerate(zip(var.dims, var.shape)):
        asked = bounds.get(axis_of(dim))
        span = (0, n) if asked is None or not n else within(axis_values(f, variables, dim, n), asked)
        if span[0] >= span[1]:
            return
        if k < 2:
            spans.append(span)
    (lo, hi), (inner_lo, inner_hi) = spans[0], spans[1] if len(spans) > 1 else (0, 1)
    rest = int(np.prod(var.shape[2:], dtype=np.int64))
    inner = max(1, min(inner_hi - inner_lo, cells // rest))
    step = max(1, cells // (rest * inner)) if inner == inner_hi - inner_lo else 1
    for i, j in product(range(lo, hi, step), range(inner_lo, inner_hi, inner)):
        yield i, min(i + step, hi), j, min(j + inner, inner_hi)


def block(f, variables: dict[str, Variable], name: str, lo: int, hi: int, inner_lo: int, inner_hi: int) -> tuple[dict[str, np.ndarray | None], np.ndarray]:
    """Axes (None: the variable has no such axis) and values of a range, the values over (time, level, lat, lon)."""
    var, axes, cuts = variables[name], dict.fromkeys(AXES), [(lo, hi), (inner_lo, inner_hi)]
    for k, dim in enumerate(var.dims):
        a, b = cuts[k] if k < 2 else (0, var.shape[k])
        axes[axis_of(dim)] = axis_values(f, variables, dim, var.shape[k])[a:b]
    values = decoded(var, read_block(f, var, lo, hi, inner_lo, inner_hi))
    held = [axis_of(d) for d in var.dims]
    values = values.transpose([held.index(a) for a in AXES if a in held])
    return axes, values.reshape([1 if axes[a] is None else len(axes[a]) for a in AXES])


def opened(path: str):
    """(file, length) at a path or URI; the file can seek, and is read by range."""
    fs, place = target(path)
    return fs.open_input_file(place), fs.get_file_info(place).size


def base(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


# ---- reading as DataFrames ---------------------------------------------------------------------

def plan(files: DataFrame, variables: list[str] | None = None, bounds: dict[str, tuple] | None = None, cells: int = CELLS) -> DataFrame:
    """A row per range to read of every file of ``files`` (path), or a single one without a range.

    ``status`` is ``ok``, ``partial`` (the file ends before its arrays do; the ranges that are there are listed), ``skipped`` (no chosen
    variable) or ``unreadable``.  ``bounds``: closed (from, to) by axis - time in microseconds since 1970, level, lat, lon.
    """
    asked, limits = variables, bounds or {}

    def rows_of_file(path: str) -> Iterator[tuple]:
        length, none = None, (None,) * 6    # the length stays null where the file can't be opened
        try:
            f, length = opened(path)
            with f:
                held = read_header(f, length)
                chosen = grid_variables(held, asked)
                if not chosen:
                    yield path, length, "skipped", "no plankton or environmental variable", *none
                    return
                short = clip(held, length)
                status, error = ("partial", f"ends early: {', '.join(short)}") if short else ("ok", None)
                listed = False
                for var in chosen:
                    per = int(np.prod(var.shape[2:], dtype=np.int64))
                    for lo, hi, a, b in ranges(f, held, var, limits, cells):
                        listed = True
                        yield path, length, status, error, var.name, lo, hi, a, b, (hi - lo) * (b - a) * per
                if not listed:
                    yield path, length, status, error, *none
        except (ValueError, EOFError, OSError) as e:
            yield path, length, "unreadable", str(e)[:200], *none

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int32()] * 4, pa.int64()]
        names = [c.split()[0] for c in PLAN.split(", ")]
        held = []
        for batch in it:
            for path in batch.column(0).to_pylist():
                for row in rows_of_file(path):
                    held.append(row)
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    return files.select("path").mapInArrow(run, PLAN)


def status(planned: DataFrame) -> DataFrame:
    """SRC-5: path, status, error, n_slabs of every planned file, from headers and lengths alone."""
    return planned.groupBy("path").agg(F.max("status").alias("status"), F.max("error").alias("error"), F.count("variable").alias("n_slabs"))


def spread(files: DataFrame, tasks: int) -> DataFrame:
    """The few rows of a listing over as many tasks: a number of partitions that is asked for is not coalesced."""
    return files.repartition(max(1, tasks))


def read_slabs(spark: SparkSession, path: str | list[str], pattern: str | None = None, variables: list[str] | None = None,
               bounds: dict[str, tuple] | None = None, cells: int = CELLS) -> DataFrame:
    """SRC-4: array-encoded slabs (``SLABS``) of the NetCDF files at or below ``path``, a row per range and level.

    The headers are read once to count ranges, and again to list them; then a task takes about ``cells`` values at a time.
    What can't be read of a file is passed over; ``status`` of ``plan`` names such files.
    """
    files = listing(spark, path, pattern or GRID_PATTERN)
    n = files.count()
    planned = plan(spread(files, min(n, max(16, -(-n // HEADERS)), 10_000)), variables, bounds, cells)
    total = planned.agg(F.sum("cells").alias("cells"), F.count("cells").alias("ranges")).first()
    by_cells, by_ranges = -(-(total["cells"] or 0) // (4 * max(cells, BATCH))), max(16, -(-total["ranges"] // HEADERS))
    tasks = max(1, min(total["ranges"], max(by_cells, by_ranges), 100_000))
    return slabs_of(planned.filter("variable IS NOT NULL").repartition(tasks))


def slabs_of(planned: DataFrame) -> DataFrame:
    """The slabs of planned ranges, read where the ranges lie."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.float64(), pa.list_(pa.timestamp("us")), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        names = ["file_source", "variable", "level", "time", "lat", "lon", "values"]
        least = np.iinfo(np.int64).min
        for batch in it:
            for row in batch.select(["path", "variable", "lo", "hi", "inner_lo", "inner_hi"]).to_pylist():
                path, name, *cut = row.values()
                f, length = opened(path)
                with f:
                    held = read_header(f, length)
                    clip(held, length)
                    axes, values = block(f, held, name, *cut)
                time = [None] if axes["time"] is None else [None if t == least else t for t in axes["time"].tolist()]
                lat, lon = ([None] if axes[a] is None else axes[a] for a in ("lat", "lon"))
                for k in range(values.shape[1]):
                    level = None if axes["level"] is None else float(axes["level"][k])
                    flat = pa.array(np.ascontiguousarray(values[:, k]).reshape(-1), from_pandas=True)
                    one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([base(path)]), pa.array([name]), pa.array([level], pa.float64()), one(time, pa.timestamp("us")),
                        one(lat, pa.float64()), one(lon, pa.float64()), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
                        schema=pa.schema(list(zip(names, kinds))))

    return planned.mapInArrow(run, SLABS)


# ---- as a data source --------------------------------------------------------------------------

@dataclass
class Range(ds.InputPartition):
    path: str
    variable: str
    cut: tuple[int, int, int, int]

    def __post_init__(self):
        super().__init__(None)


@dataclass
class Files(ds.InputPartition):
    """Whole files, whose headers are read by the task."""
    paths: list[str]

    def __post_init__(self):
        super().__init__(None)


class NetcdfReader(ds.DataSourceReader):
    """Single cells; a partition per range of records of a variable or, of more than ``FILES`` files, per group of files of up to
    ``GROUP`` bytes (files beyond that are cut into ranges), whose ranges the task chooses."""

    FILTERS = {("variable",): None, ("time",): "time", ("level",): "level", ("latitude",): "lat", ("longitude",): "lon"}

    def __init__(self, options: dict):
        self.path, self.cells = options["path"], int(options.get("cells", CELLS))
        self.variables = options["variables"].split(",") if options.get("variables") else None
        self.bounds: dict[str, tuple] = {}

    def pushFilters(self, filters):
        """Ranges are chosen by filters that compare an axis or the variable's name with a value; Spark applies all filters again."""
        for one in filters:
            axis = self.FILTERS.get(getattr(one, "attribute", None))
            value = getattr(one, "value", None)
            if isinstance(one, (ds.EqualTo, ds.In)) and one.attribute == ("variable",):
                names = [value] if isinstance(one, ds.EqualTo) else list(value)
                self.variables = [n for n in names if self.variables is None or n in self.variables]
            elif axis and value is not None:
                value = int(np.datetime64(value, "us").astype(np.int64)) if axis == "time" else float(value)
                lo, hi = self.bounds.get(axis, (None, None))
                if isinstance(one, (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual)):
                    lo = value if lo is None else max(lo, value)
                if isinstance(one, (ds.EqualTo, ds.LessThan, ds.LessThanOrEqual)):
                    hi = value if hi is None else min(hi, value)
                self.bounds[axis] = lo, hi
            yield one

    def files(self) -> list[tuple[str, int]]:
        """(path, length), by path."""
        fs, place = target(self.path)
        info = fs.get_file_info(place)
        if info.type == pafs.FileType.File:
            return [(self.path, info.size)]
        uri = self.path if "://" in self.path else f"file://{place}"
        head = uri[:len(uri.rstrip("/")) - len(place.rstrip("/"))]
        found = fs.get_file_info(pafs.FileSelector(place, recursive=True))
        return sorted((head + i.path, i.size) for i in found if i.type == pafs.FileType.File and i.path.lower().endswith((".nc", ".nc4", ".netcdf")))

    def ranges_of(self, path: str) -> Iterator[Range]:
        f, length = opened(path)
        with f:
            held = read_header(f, length)
            for v in grid_variables(held, self.variables):
                for cut in ranges(f, held, v, self.bounds, self.cells):
                    yield Range(path, v.name, cut)

    def partitions(self):
        found = self.files()
        if len(found) <= FILES:
            return [r for path, _ in found for r in self.ranges_of(path)]
        out, held, size = [], [], 0
        # as many groups as files that may be planned one by one, or more if their bytes ask for it
        most = max(1, min(GROUP, -(-sum(n for _, n in found) // FILES)))
        for path, n in found:
            if n > GROUP:
                out += self.ranges_of(path)
                continue
            held.append(path)
            size += n
            if size >= most:
                out.append(Files(held))
                held, size = [], 0
        return out + ([Files(held)] if held else [])

    def read(self, part: Range | Files) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        if isinstance(part, Range):
            yield from self.cells_of(part)
            return
        held, rows = [], 0
        for batch in (b for path in part.paths for r in self.ranges_of(path) for b in self.cells_of(r)):
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def cells_of(self, part: Range) -> Iterator[pa.RecordBatch]:
        f, length = opened(part.path)
        with f:
            axes, values = block(f, read_header(f, length), part.variable, *part.cut)
        flat, least = values.reshape(-1), np.iinfo(np.int64).min
        for i in range(0, len(flat), BATCH):
            at = np.unravel_index(np.arange(i, min(i + BATCH, len(flat))), values.shape)
            n, cols = len(at[0]), {}
            for axis, index in zip(AXES, at):
                kind = pa.timestamp("us") if axis == "time" else pa.float64()
                if axes[axis] is None:
                    cols[axis] = pa.nulls(n, kind)
                elif axis == "time":
                    t = axes[axis][index]
                    cols[axis] = pa.array(t, pa.int64(), mask=t == least).cast(kind)
                else:
                    cols[axis] = pa.array(axes[axis][index], kind, from_pandas=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([base(part.path)] * n), pa.array([part.variable] * n), cols["time"], cols["level"], cols["lat"], cols["lon"],
                 pa.array(flat[i:i + n], from_pandas=True)], ["file_source", "variable", "time", "level", "latitude", "longitude", "value"])


class NetcdfSource(ds.DataSource):
    """``spark.read.format("netcdf").load(path)``; options ``variables`` (names, comma between) and ``cells`` (values of a partition).

    Up to ``FILES`` headers are read while planning; of more files only names and lengths are listed, and tasks read the headers.
    A file that is no classic NetCDF file fails the read.
    """

    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def schema(self) -> str:
        return CELL_ROWS

    def reader(self, schema) -> NetcdfReader:
        return NetcdfReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format ``netcdf`` known to the session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfSource)


# ---- writing -------------------------------------------------------------------------------------

def encode_file(variables: list[tuple], version: int = 2, units: str = "microseconds since 1970-01-01 00:00:00") -> bytes:
    """A classic file of (name, time in microseconds, lat, lon, values) grids on one grid: time is the record dimension and
    is stored in doubles; values are doubles, NaN where missing."""
    time, lat, lon = (np.asarray(x, np.float64) for x in variables[0][1:4])
    if not all(np.array_equal(a, b) for v in variables for a, b in zip(v[1:4], variables[0][1:4])):
        raise ValueError("the variables of a file are on different grids")
    big = version == 5
    count = lambda n: struct.pack(">q" if big else ">i", n)
    offset = lambda n: struct.pack(">i" if version == 1 else ">q", n)
    text = lambda s: count(len(s.encode())) + s.encode() + b"\0" * (-len(s.encode()) % 4)
    tag = lambda k, n: struct.pack(">i", k if n else 0) + count(n)
    attribute = lambda key, value: text(key) + struct.pack(">i", 2) + text(value)
    fixed = [("lat", (1,), lat), ("lon", (2,), lon)]
    moving = [("time", (0,), time)] + [(v[0], (0, 1, 2), np.asarray(v[4], np.float64)) for v in variables]
    size = {n: 8 * (1 if n == "time" else len(lat) * len(lon)) for n, *_ in moving}

    def header(begins: dict[str, int]) -> bytes:
        out = b"CDF" + bytes([version]) + count(len(time))
        out += tag(DIMENSION, 3) + text("time") + count(0) + text("lat") + count(len(lat)) + text("lon") + count(len(lon))
        out += tag(ATTRIBUTE, 0) + tag(VARIABLE, len(fixed) + len(moving))
        for name, dims, data in fixed + moving:
            out += text(name) + count(len(dims)) + b"".join(map(count, dims))
            out += tag(ATTRIBUTE, 1) + attribute("units", units) if name == "time" else tag(ATTRIBUTE, 0)
            stored = size.get(name, 8 * len(data))
            out += struct.pack(">i", 6) + count(stored if big or stored < 2 ** 31 else -1) + offset(begins[name])
        return out

    begins, at = dict.fromkeys([n for n, *_ in fixed + moving], 0), len(header(dict.fromkeys([n for n, *_ in fixed + moving], 0)))
    for name, _, data in fixed:
        begins[name], at = at, at + 8 * len(data)
    for name, *_ in moving:
        begins[name], at = at, at + size[name]
    body = b"".join(data.astype(">f8").tobytes() for _, _, data in fixed)
    rows = [data.reshape(len(time), -1).astype(">f8") for _, _, data in moving] if len(time) else []
    return header(begins) + body + b"".join(r[i].tobytes() for i in range(len(time)) for r in rows)


def write_files(files: DataFrame, folder: str, version: int = 2) -> DataFrame:
    """Write a file per row of ``files`` (name, slabs: array of (variable, time, lat, lon, values), all on one grid) under ``folder``;
    gives (path, length).  A file is written under a temporary name and moved, so a repeated task leaves it whole.  It is the
    caller's to see that a row, which is a file, fits a task."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = target(folder)
        fs.create_dir(root, recursive=True)
        for batch in it:
            for i in range(batch.num_rows):
                name = batch.column("name")[i].as_py()
                held = batch.column("slabs")[i].values
                of = lambda column, k, kind, none: held.field(column)[k].values.cast(kind).fill_null(none).to_numpy()
                by_name = sorted(zip(held.field("variable").to_pylist(), range(len(held))))
                data = encode_file([(v, of("time", k, pa.int64(), np.iinfo(np.int64).min), *[of(c, k, pa.float64(), np.nan) for c in ("lat", "lon", "values")])
                                    for v, k in by_name], version)
                write_whole(fs, root, name, data)
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([len(data)], pa.int64())], ["path", "length"])

    return files.select("name", "slabs").mapInArrow(run, "path string, length long")
