"""Areal disaggregation of catch totals over a regular global raster (RAS-1..5, JN-5, JN-6).

Cells are generated, not searched: an area's bounds become integer index ranges
(``sequence`` + ``explode``), so the range join of the reference is plain arithmetic.
Totals are aggregated before any explode; the exploding rows are spread over tasks first.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from movegrid.params import AREA_BOUNDS

BOUNDS_SCHEMA = StructType([
    StructField("code", IntegerType(), False),
    StructField("name", StringType(), False),
    StructField("lat_min", DoubleType(), False),
    StructField("lat_max", DoubleType(), False),
    StructField("lon_min", DoubleType(), False),
    StructField("lon_max", DoubleType(), False),
])


def area_bounds(spark: SparkSession) -> DataFrame:
    """The 21-row area-bounds dimension; joins with bounds of any number carry no hint."""
    return spark.createDataFrame(AREA_BOUNDS, BOUNDS_SCHEMA)


def axis_length(span: float, resolution: float) -> int:
    """RAS-1: number of axis points from -span/2 to +span/2 inclusive with exact steps (D26)."""
    return int(math.floor(span / resolution + 1e-9)) + 1


def _index_range(lo, hi, origin: float, resolution: float, n: int):
    """Indices i in [0, n) with lo <= origin + i*res <= hi (inclusive bounds)."""
    first = F.greatest(F.ceil((lo - F.lit(origin)) / F.lit(resolution) - F.lit(1e-9)), F.lit(0)).cast("int")
    last = F.least(F.floor((hi - F.lit(origin)) / F.lit(resolution) + F.lit(1e-9)), F.lit(n - 1)).cast("int")
    return first, last


def _cells_for(df: DataFrame, resolution: float, wrap_antimeridian: bool) -> DataFrame:
    """Add lat index list and lon index list columns (``_lat_ix``, ``_lon_ix``) and cell count."""
    n_lat, n_lon = axis_length(180.0, resolution), axis_length(360.0, resolution)
    la, lb = _index_range(F.col("lat_min"), F.col("lat_max"), -90.0, resolution, n_lat)
    oa, ob = _index_range(F.col("lon_min"), F.col("lon_max"), -180.0, resolution, n_lon)
    lat_ix = F.when(la <= lb, F.sequence(la, lb)).otherwise(F.array().cast("array<int>"))
    straight = F.when(oa <= ob, F.sequence(oa, ob)).otherwise(F.array().cast("array<int>"))
    if wrap_antimeridian:
        # D13: lon_min > lon_max crosses the antimeridian: [lon_min, 180] and [-180, lon_max]
        wa, _ = _index_range(F.col("lon_min"), F.lit(180.0), -180.0, resolution, n_lon)
        _, wb = _index_range(F.lit(-180.0), F.col("lon_max"), -180.0, resolution, n_lon)
        wrapped = F.concat(F.sequence(wa, F.lit(n_lon - 1)), F.sequence(F.lit(0), wb))
        lon_ix = F.when(F.col("lon_min") > F.col("lon_max"), wrapped).otherwise(straight)
    else:
        lon_ix = straight
    return (df.withColumn("_lat_ix", lat_ix).withColumn("_lon_ix", lon_ix)
            .withColumn("_n_cells", F.size("_lat_ix") * F.size("_lon_ix")))


def _allocate(totals: DataFrame, bounds: DataFrame, resolution: float, wrap_antimeridian: bool,
              keys: list[str], spread_partitions: int | None) -> DataFrame:
    """JN-6 + RAS-2: join totals to bounds (unknown areas drop out), explode to cells."""
    b = bounds.select(F.col("code").alias("area_code"), F.col("name").alias("area_name"),
                      "lat_min", "lat_max", "lon_min", "lon_max")
    j = _cells_for(totals.join(b, "area_code", "inner"), resolution, wrap_antimeridian)
    j = j.where(F.col("_n_cells") > 0)
    rows = j.select(*keys, "area_name", "value", "_n_cells", "_lon_ix", F.explode("_lat_ix").alias("lat_idx"))
    # few total rows fan out to many cells: spread the latitude rows before the second explode
    rows = rows.repartition(spread_partitions, *keys, "lat_idx") if spread_partitions else \
        rows.repartition(*keys, "lat_idx")
    cells = rows.select(*keys, "area_name", "lat_idx", F.explode("_lon_ix").alias("lon_idx"),
                        (F.col("value") / F.col("_n_cells")).alias("catch"))
    return cells.withColumns({
        "lat": F.lit(-90.0) + F.col("lat_idx") * F.lit(resolution),
        "lon": F.lit(-180.0) + F.col("lon_idx") * F.lit(resolution),
    })


def cells(area_period_totals: DataFrame, bounds: DataFrame, resolution: float = 1.0,
          wrap_antimeridian: bool = True, spread_partitions: int | None = None) -> DataFrame:
    """RAS-3: cell list (lat, lon, catch, area_code, area_name, period) of every area-period total."""
    c = _allocate(area_period_totals.select("area_code", "period", "value"), bounds, resolution,
                  wrap_antimeridian, ["area_code", "period"], spread_partitions)
    return c.select("lat_idx", "lon_idx", "lat", "lon", "catch", "area_code", "area_name", "period")


def grid(area_period_totals: DataFrame, bounds: DataFrame, resolution: float = 1.0,
         wrap_antimeridian: bool = True, spread_partitions: int | None = None) -> DataFrame:
    """RAS-4/AGG-13: accumulated sparse grid.  Periods are summed before the explode (sum is linear)."""
    per_area = area_period_totals.groupBy("area_code").agg(F.sum("value").alias("value"))
    c = _allocate(per_area, bounds, resolution, wrap_antimeridian, ["area_code"], spread_partitions)
    return c.groupBy("lat_idx", "lon_idx", "lat", "lon").agg(F.sum("catch").alias("catch"))


def unallocated(area_period_totals: DataFrame, bounds: DataFrame, resolution: float = 1.0,
                wrap_antimeridian: bool = True) -> DataFrame:
    """Totals that reach no cell: unknown area codes or bounds with no grid point (FIL-14, D13)."""
    b = bounds.select(F.col("code").alias("area_code"), "lat_min", "lat_max", "lon_min", "lon_max")
    j = _cells_for(area_period_totals.join(b, "area_code", "left"), resolution, wrap_antimeridian)
    return j.where(F.col("lat_min").isNull() | (F.col("_n_cells") == 0)).select("area_code", "period", "value")


def stats(grid_cells: DataFrame, resolution: float = 1.0) -> DataFrame:
    """AGG-14: grid shape, non-zero cells, total distributed."""
    return grid_cells.agg(
        F.lit(axis_length(180.0, resolution)).alias("n_lat"),
        F.lit(axis_length(360.0, resolution)).alias("n_lon"),
        F.count_if(F.col("catch") != 0).alias("nonzero_cells"),
        F.coalesce(F.sum("catch"), F.lit(0.0)).alias("total_distributed"),
    )


def lon_label(i: int, resolution: float) -> str:
    return f"lon_{-180.0 + i * resolution:.1f}"


def wide(grid_cells: DataFrame, resolution: float = 1.0) -> DataFrame:
    """SNK-2: dense matrix, one row per latitude (``lat_y.y``), one column per longitude, 0 filled.

    The pivot values are the fixed axis, so Spark needs no pass to discover them.
    """
    spark = grid_cells.sparkSession
    n_lat, n_lon = axis_length(180.0, resolution), axis_length(360.0, resolution)
    lats = spark.range(n_lat).select(F.col("id").cast("int").alias("lat_idx"))
    piv = grid_cells.groupBy("lat_idx").pivot("lon_idx", list(range(n_lon))).agg(F.sum("catch"))
    dense = lats.join(piv, "lat_idx", "left")
    cols = [F.format_string("lat_%.1f", F.lit(-90.0) + F.col("lat_idx") * F.lit(resolution)).alias("lat")]
    cols += [F.coalesce(F.col(str(i)), F.lit(0.0)).alias(lon_label(i, resolution)) for i in range(n_lon)]
    return dense.select(*cols)
