"""Gridded-variable sources: array-encoded slabs to long/wide rows, sample grid."""
from __future__ import annotations

import datetime as _dt
import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from movegrid.functions import resolve
from movegrid.functions.text import base_name
from movegrid.params import ENVIRONMENT_KEYWORDS, PLANKTON_KEYWORDS

SLAB_SCHEMA = ("file_source string, variable string, time array<timestamp_ntz>, lat array<double>, "
               "lon array<double>, values array<double>")


def read_array_slabs(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = SLAB_SCHEMA) -> DataFrame:
    """Scan array-encoded grid slabs (any Spark format).

    What can't be read of a file is passed over (SRC-5); ``slab_status`` names every such file.
    The slab layout is fixed, so the schema is given rather than inferred from some file.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    from_path = base_name(F.col("_metadata.file_path"))  # PRJ-9
    if "file_source" in df.columns:
        return df.withColumn("file_source", F.coalesce(F.col("file_source"), from_path))
    return df.withColumn("file_source", from_path)


def slab_status(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = SLAB_SCHEMA,
                glob: str = "*") -> DataFrame:
    """SRC-5: one row per file under ``path``: path, status, error, n_slabs.

    ``ok`` if slabs with a chosen variable were read, ``skipped`` if the file has none, ``partial``
    if fewer rows could be read than the file's footer counts, ``unreadable`` if nothing could be
    read of a file that is not empty.  Every column is decoded, as a damaged one loses rows, too.
    Formats without row counts in a footer (JSON, CSV, Avro) can't show that rows are missing.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    df = (reader.schema(schema) if schema else reader).load(path)
    name = F.lower("variable")
    chosen = reduce(lambda a, b: a | b, [name.contains(k) for k in PLANKTON_KEYWORDS + ENVIRONMENT_KEYWORDS])
    of = F.col("_metadata.file_path").alias("path")
    held = df.groupBy(of).agg(F.count(F.lit(1)).alias("held"))         # no column is read: the footers' counts
    sizes = [F.coalesce(F.size(c) if t.startswith("array") else F.length(F.col(c).cast("string")), F.lit(0)) for c, t in df.dtypes]
    decoded = reduce(lambda a, b: a + b, sizes) > -2 * len(sizes)      # always true, known from the values only
    read = df.groupBy(of).agg(F.count_if(decoded).alias("n"), F.count_if(chosen & decoded).alias("n_slabs"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
             .select(F.col("_metadata.file_path").alias("path"), "length"))
    n, used, rows = (F.coalesce(c, F.lit(0)) for c in ("n", "n_slabs", "held"))
    status = F.when((n > 0) & (n < rows), "partial").when(used > 0, "ok").when((n > 0) | (F.col("length") == 0), "skipped").otherwise("unreadable")
    error = (F.when(status == "skipped", "no plankton or environmental variable").when(status == "unreadable", "no slab could be read")
             .when(status == "partial", F.format_string("%d of %d rows could be read", n, rows)))
    return files.join(read, "path", "left").join(held, "path", "left").select("path", status.alias("status"), error.alias("error"), used.alias("n_slabs"))


def tiles(slabs: DataFrame) -> DataFrame:
    """Slabs cut by time step: one row per (file, variable, time) with that step's values, so a row
    holds one map however long a file's time axis is."""
    size = F.size("lat") * F.size("lon")
    level = [c for c in ("level",) if c in slabs.columns]
    cut = slabs.select("file_source", "variable", *level, "lat", "lon", "values", size.alias("_n"), F.posexplode("time").alias("_t", "time"))
    return cut.select("file_source", "variable", *level, "time", "lat", "lon", F.slice("values", F.col("_t") * F.col("_n") + 1, F.col("_n")).alias("values"))


def slabs_to_wide(slabs: DataFrame, variables: list[str], time_name: str = "time", lat_name: str = "latitude",
                  lon_name: str = "longitude", drop_incomplete: bool = True) -> DataFrame:
    """SRC-4 (wide) + FIL-6 without a row per cell and variable in the shuffle.

    The few rows of a (file, time step, grid) are brought together with their arrays, and the
    cells are unfolded once.  A cell is dropped when any variable of its own file is missing; a
    variable a file lacks stays NULL.  NaN is NULL.  Slabs with a ``level`` keep it as a column.
    """
    level = [c for c in ("level",) if c in slabs.columns]
    held = tiles(slabs).where(F.col("variable").isin(*variables)).groupBy("file_source", *level, "time", "lat", "lon").agg(
        *[F.max(F.when(F.col("variable") == v, F.col("values"))).alias(f"_{i}") for i, v in enumerate(variables)])
    n_lon = F.size("lon")
    cells = held.select("*", F.explode(F.sequence(F.lit(0), F.size("lat") * n_lon - 1)).alias("_at"))
    value = [F.get(F.col(f"_{i}"), F.col("_at")) for i in range(len(variables))]
    value = [F.when(~F.isnan(v), v) for v in value]
    if drop_incomplete:
        whole = reduce(lambda a, b: a & b, [F.col(f"_{i}").isNull() | v.isNotNull() for i, v in enumerate(value)])
        cells = cells.where(whole)
    return cells.select(
        "file_source", *level, F.col("time").alias(time_name), F.get("lat", F.floor(F.col("_at") / n_lon).cast("int")).alias(lat_name),
        F.get("lon", (F.col("_at") % n_lon).cast("int")).alias(lon_name), *[v.alias(name) for v, name in zip(value, variables)])


def slab_variables(slabs: DataFrame) -> list[str]:
    """SEL-1/2, SET-4: the plankton and environmental variables that the slabs hold (names only)."""
    found = [r[0] for r in slabs.select("variable").distinct().collect()]
    return resolve.variable_columns(sorted(x for x in found if x is not None))


def explode_slabs(slabs: DataFrame, time_name: str = "time", lat_name: str = "latitude",
                  lon_name: str = "longitude") -> DataFrame:
    """SRC-4 (long form): one row per (file, variable, time, lat, lon) from array-encoded slabs.

    ``flat_index = (t * n_lat + y) * n_lon + x``; NaN values become NULL at this boundary.
    """
    n_lat, n_lon = F.size("lat"), F.size("lon")
    e = slabs.select("file_source", "variable", "time", "lat", "lon",
                     F.posexplode("values").alias("_pos", "_v"))
    t = F.floor(e["_pos"] / (n_lat * n_lon)).cast("int")
    y = (F.floor(e["_pos"] / n_lon) % n_lat).cast("int")
    x = (e["_pos"] % n_lon).cast("int")
    return e.select(
        "file_source", "variable",
        F.element_at("time", t + 1).alias(time_name),
        F.element_at("lat", y + 1).alias(lat_name),
        F.element_at("lon", x + 1).alias(lon_name),
        F.when(F.isnan("_v"), F.lit(None)).otherwise(F.col("_v")).alias("value"),
    )


def to_wide(long: DataFrame, variables: list[str] | None = None, time_name: str = "time",
            lat_name: str = "latitude", lon_name: str = "longitude", drop_incomplete: bool = True) -> DataFrame:
    """SRC-4 (wide) + FIL-6: one column per variable.  A cell is dropped when any variable of its
    own file is missing (files are cleaned before they are combined, so a variable a file lacks
    stays NULL).  ``variables`` fixes the output columns; otherwise the distinct names are read.
    """
    if variables is None:
        variables = sorted(r[0] for r in long.select("variable").distinct().collect())  # bounded: names only
    keys = ["file_source", time_name, lat_name, lon_name]
    aggs = [F.max(F.when(F.col("variable") == F.lit(v), F.col("value"))).alias(v) for v in variables]
    aggs.append(F.count_if(F.col("value").isNull()).alias("_mg_missing"))
    w = long.groupBy(*keys).agg(*aggs)
    if drop_incomplete:
        w = w.where(F.col("_mg_missing") == 0)
    return w.drop("_mg_missing")


def sample_grid(spark: SparkSession, seed: int = 42, n_lat: int = 20, n_lon: int = 20,
                start: str = "2021-08-01", end: str = "2021-09-30") -> DataFrame:
    """SRC-6/JN-8: the sample grid (lats x lons x days) with the same seasonal formulas.

    Random draws come from Spark's seeded generators, so values differ from NumPy's.
    Used when no grid files are given; never registered as a benchmark query.
    """
    d0, d1 = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    n_days = (d1 - d0).days + 1
    lat_step, lon_step = (55.0 - 50.0) / (n_lat - 1), (5.0 - 1.0) / (n_lon - 1)
    cells = (spark.range(n_lat * n_lon * n_days)
             .select((F.floor(F.col("id") / (n_lon * n_days))).alias("i"),
                     (F.floor(F.col("id") / n_days) % n_lon).alias("j"),
                     (F.col("id") % n_days).cast("int").alias("d")))
    lat = F.lit(50.0) + F.col("i") * F.lit(lat_step)
    lon = F.lit(1.0) + F.col("j") * F.lit(lon_step)
    day = F.date_add(F.lit(d0.isoformat()).cast("date"), F.col("d"))
    rad = F.lit(math.pi / 180)
    lat_f, lon_f = F.sin(lat * rad), F.cos(lon * rad)
    time_f = F.sin(F.dayofyear(day) * F.lit(2 * math.pi / 365))
    expo = lambda scale, s: -F.lit(scale) * F.log(F.lit(1.0) - F.rand(s))
    return cells.select(
        lat.alias("latitude"), lon.alias("longitude"), day.cast("timestamp_ntz").alias("time"),
        (expo(100.0, seed) * lat_f * time_f).alias("acartia_abundance"),
        (expo(200.0, seed + 1) * lon_f * time_f).alias("calanus_abundance"),
        (expo(50.0, seed + 2) * (lat_f + lon_f)).alias("metridia_abundance"),
        (F.lit(15.0) + F.lit(5.0) * time_f + F.randn(seed + 3)).alias("temperature"),
        (F.lit(35.0) + F.lit(0.5) * F.randn(seed + 4)).alias("salinity"),
        expo(5.0, seed + 5).alias("nitrate"),
        F.lit("sample_data.nc").alias("file_source"),
    )
