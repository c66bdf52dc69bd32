"""Model features: binned track/grid alignment, imputation, encodings, correlation, split."""
from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from movegrid.functions import resolve
from movegrid.functions.ordering import arithmetic_hash, exact_medians, with_global_index
from movegrid.functions.scalars import attach_one_row
from movegrid.functions.spatial import bin_index, spatial_bin
from movegrid.operators import grids
from movegrid.operators.asof import asof_join
from movegrid.session import ensure_checkpoint_dir

TRACK_FEATURES = ["Latitude", "Longitude", "month", "day_of_year", "distance", "speed"]


def track_bin_means(tracks: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """AGG-15: mean speed, distance and position per 0.1-degree bin (integer keys for exact joins)."""
    return (tracks.groupBy(bin_index(F.col(lat)).alias("lat_key"), bin_index(F.col(lon)).alias("lon_key"))
            .agg(F.avg("speed").alias("speed"), F.avg("distance").alias("distance"),
                 F.avg(lat).alias(lat), F.avg(lon).alias(lon)))


def bin_join(tracks: DataFrame, grid: DataFrame | None, impute: str | None = "median") -> DataFrame:
    """AGG-15..17, JN-4: track bin means left-joined to grid bin means on the integer bin keys.

    Missing abundance means are filled with the median over the joined rows (temperature is
    not imputed).  Both sides are aggregated before the join, so the join sees one row per bin.
    The exact median is computed distributed (``exact_medians``), not merged in one task.
    """
    t = track_bin_means(tracks)
    if grid is None:
        out = t
    else:
        g = grids.binned_means(grid)
        out = t.join(g, ["lat_key", "lon_key"], "left")
        fill = resolve.abundance_columns(g.columns) if impute == "median" else []
        if fill:
            # The bin table (one row per occupied cell) is frozen once, so the median pass and
            # the output read it instead of recomputing both aggregation pipelines.
            ensure_checkpoint_dir(out.sparkSession)
            out = out.checkpoint(eager=True)
            med = exact_medians(out, fill)
            out = attach_one_row(out, med)
            out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in fill})
            out = out.drop(*[f"_med_{c}" for c in fill])
    return out.withColumns({"lat_bin": F.col("lat_key") / F.lit(10.0), "lon_bin": F.col("lon_key") / F.lit(10.0)})


def asof_environment(fixes: DataFrame, grid: DataFrame, values: list[str], ts: str = "Date", time: str = "time",
                     order: str = "row_order", tolerance_days: float | None = None, **kw) -> DataFrame:
    """JN-7: every fix with the grid's ``values`` in its 0.1-degree bin at the latest grid time at or before it; of grid rows
    at one time in a bin that with the greatest ``order``."""
    binned = lambda df, lat, lon: df.withColumns({"lat_key": bin_index(F.col(lat)), "lon_key": bin_index(F.col(lon))})
    g = binned(grid, "latitude", "longitude").select("lat_key", "lon_key", F.col(time).alias("grid_time"), F.col(order).alias("grid_order"), *values)
    return asof_join(binned(fixes, "Latitude", "Longitude"), g, ["lat_key", "lon_key"], ts, "grid_time", values, F.col("grid_order"),
                     matched="grid_time", tolerance_days=tolerance_days, **kw)


def encodings(df: DataFrame) -> DataFrame:
    """PRJ-10..13: feature projection, bins, cyclic month/day, log1p movement, centred coordinates."""
    two_pi = F.lit(2 * math.pi)
    f = df.select(*TRACK_FEATURES).withColumns({
        "lat_bin": spatial_bin(F.col("Latitude")),
        "lon_bin": spatial_bin(F.col("Longitude")),
        "sin_month": F.sin(two_pi * F.col("month") / F.lit(12)),
        "cos_month": F.cos(two_pi * F.col("month") / F.lit(12)),
        "sin_day": F.sin(two_pi * F.col("day_of_year") / F.lit(365)),
        "cos_day": F.cos(two_pi * F.col("day_of_year") / F.lit(365)),
        "log_distance": F.log1p("distance"),
        "log_speed": F.log1p("speed"),
    })
    means = df.agg(F.avg("Latitude").alias("_mlat"), F.avg("Longitude").alias("_mlon"))
    f = attach_one_row(f, means)
    return f.withColumns({"lat_centered": F.col("Latitude") - F.col("_mlat"),
                          "lon_centered": F.col("Longitude") - F.col("_mlon")}).drop("_mlat", "_mlon")


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-22: pairwise-complete Pearson correlation in long form (var_a, var_b, corr, n) with
    a after b in column order (the lower triangle).  One aggregate pass; a constant column gives NULL."""
    aggs = []
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        xa, xb = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        aggs += [F.covar_samp(xa, xb).alias(f"c{i}"), F.stddev_samp(xa).alias(f"sa{i}"),
                 F.stddev_samp(xb).alias(f"sb{i}"), F.count(xa).alias(f"n{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                              F.try_divide(F.col(f"c{i}"), F.col(f"sa{i}") * F.col(f"sb{i}")).alias("corr"),
                              F.col(f"n{i}").alias("n"))
                     for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(rows))


def bin_split_key(decimals: int = 1) -> Column:
    """A non-negative number for each spatial bin, unique on the globe at the grid of ``bin_index``."""
    lat, lon = 90 * 10 ** decimals, 180 * 10 ** decimals
    width = 10 ** len(str(2 * lon))
    return (F.col("lat_key") + F.lit(lat)) * F.lit(width) + (F.col("lon_key") + F.lit(lon))


def split_order(key: Column, seed: int = 42) -> list[Column]:
    return [arithmetic_hash(key, seed), key]


def split(df: DataFrame, order: list[Column], test_size: float = 0.2) -> DataFrame:
    """ML-1: exact-size split: the ``ceil(test_size * n)`` first rows of a hash order are 'test'.

    The global position comes from a distributed index (no single-task window, no row cap).
    """
    idx = with_global_index(df, order, "_mg_idx")
    n = idx.agg(F.count(F.lit(1)).alias("_mg_n"))
    idx = attach_one_row(idx, n)
    test = F.col("_mg_idx") < F.ceil(F.col("_mg_n") * F.lit(float(test_size)))
    return idx.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_mg_idx", "_mg_n")


def fold(df: DataFrame, order: list[Column], k: int = 5) -> DataFrame:
    """ML-7 fold id: position in the hash order modulo k (balanced folds)."""
    idx = with_global_index(df, order, "_mg_idx")
    return idx.withColumn("fold", (F.col("_mg_idx") % k).cast("int")).drop("_mg_idx")


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """FIL-12."""
    return df.na.drop(how="any", subset=columns)
