"""Gridded-variable operators: union, selection, profiles, per-variable summaries, samples."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from movegrid.functions import resolve
from movegrid.functions.ordering import top_k_by_order
from movegrid.functions.spatial import bin_index, spatial_bin


def union_files(frames: list[DataFrame]) -> DataFrame | None:
    """SET-1: combine per-file tables by column name, missing columns filled with NULL.

    ``None`` when no file produced rows (SRC-5: all files skipped).
    """
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def select_variables(df: DataFrame, keep: tuple[str, ...] = ("time", "latitude", "longitude", "file_source"),
                     variables: list[str] | None = None, drop_incomplete: bool = True) -> DataFrame:
    """SEL-1/2, SET-4, FIL-6 for one file: coordinates + chosen variables, rows with any gap dropped."""
    cols = list(df.columns)
    vars_ = variables if variables is not None else resolve.variable_columns(cols, exclude=keep)
    coords = [c for c in cols if c in keep]
    out = df.select(*coords, *vars_)
    if drop_incomplete:
        out = out.na.drop(how="any", subset=[c for c in coords + vars_ if c != "file_source"])
    return out


def union_selected(df: DataFrame, file_columns: dict[str, list[str]],
                   keep: tuple[str, ...] = ("time", "latitude", "longitude", "file_source"), drop_incomplete: bool = True) -> DataFrame:
    """SET-1 + SEL-1/2 + SET-4 + FIL-6 over many files in one scan.

    ``df`` holds the rows of all files (``file_source``); ``file_columns`` names the columns each
    file has.  The variables of a file are chosen by name, a variable it lacks is NULL, and a row
    goes if a coordinate or a variable of its own file is missing.  Files not named are left out.
    """
    variables = {f: resolve.variable_columns(cols, exclude=keep) for f, cols in file_columns.items()}
    by_choice: dict[str, list[str]] = {}
    for f, chosen in variables.items():
        for v in chosen:
            by_choice.setdefault(v, []).append(f)
    source = F.col("file_source")
    out = df.where(source.isin(*variables)).select(
        *[c for c in df.columns if c in keep], *[F.when(source.isin(*files), F.col(v)).alias(v) for v, files in by_choice.items()])
    if drop_incomplete:
        coords = [c for c in out.columns if c in keep and c != "file_source"]
        out = out.na.drop(how="any", subset=coords)
        for v, files in by_choice.items():
            out = out.where(F.col(v).isNotNull() | ~source.isin(*files))
    return out


def bounds(df: DataFrame) -> DataFrame:
    """AGG-6: spatial bounds (lat/lon columns found by name, SEL-3)."""
    lat = resolve.first_containing(df.columns, "lat")
    lon = resolve.first_containing(df.columns, "lon")
    return df.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                  F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))


def profile(df: DataFrame) -> DataFrame:
    """AGG-7 + SEL-8 + SNK-7: rows, distinct source files (1 when untracked), variable counts, columns."""
    files = F.countDistinct("file_source") if "file_source" in df.columns else F.lit(1).cast("long")
    cols = df.columns
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        files.alias("unique_files"),
        F.lit(len(resolve.abundance_columns(cols))).alias("n_abundance_vars"),
        F.lit(len(resolve.summary_environment_columns(cols))).alias("n_env_vars"),
        F.lit(len(cols)).alias("n_columns"),
    )


def variable_summary(df: DataFrame, columns: list[str], with_count: bool = True) -> DataFrame:
    """AGG-8/AGG-9: per variable mean, sample std, min, max (and non-missing count).

    All statistics come from one aggregate pass over the wide table; only the one-row
    result is reshaped to tidy rows, so no row is multiplied per variable.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "variable string, mean double, std double, min double, max double"
                                               + (", count long" if with_count else ""))
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"lo{i}"),
                 F.max(v).alias(f"hi{i}"), F.count(v).alias(f"n{i}")]
    one = df.agg(*aggs)
    fields = lambda i: [F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")] + \
        ([F.col(f"n{i}").alias("count")] if with_count else [])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), *fields(i)) for i, c in enumerate(columns)])
    return one.select(F.inline(rows))


def plankton_summary(df: DataFrame, parity: bool = False) -> DataFrame:
    cols = resolve.numeric_columns(df, resolve.summary_plankton_columns(df.columns), parity)
    return variable_summary(df, cols, with_count=True)


def environment_summary(df: DataFrame, parity: bool = False) -> DataFrame:
    cols = resolve.numeric_columns(df, resolve.summary_environment_columns(df.columns), parity)
    return variable_summary(df, cols, with_count=False)


def mean_by_time(df: DataFrame, time_col: str = "time") -> DataFrame:
    """AGG-19: mean of every abundance column per time step."""
    cols = resolve.abundance_columns(df.columns)
    return df.groupBy(time_col).agg(*[F.avg(c).alias(c) for c in cols])


def sample_rows(df: DataFrame, order: list[Column], n: int = 1000) -> DataFrame:
    """ORD-5: fixed-size sample (min(n, rows)) as a deterministic hash-ordered top-k."""
    return top_k_by_order(df, order, n)


def positive_scaled(df: DataFrame, max_vars: int | None = None, factor: float = 1.0,
                    lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """FIL-11 + AGG-30 + PRJ-17: per abundance column (all, or the first ``max_vars`` to draw), positive values
    scaled by that column's maximum; long form (variable, latitude, longitude, value, scaled).

    One pass: the columns are stacked once, the per-variable maxima form a table with one row
    per column (a bounded broadcast), and the rows are scaled through that lookup.
    """
    cols = resolve.abundance_columns(df.columns, max_vars)
    stacked = df.select(F.col(lat).alias("latitude"), F.col(lon).alias("longitude"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("_s")).select("_s.variable", "latitude", "longitude", "_s.value").where(F.col("value") > 0)
    maxima = stacked.groupBy("variable").agg(F.max("value").alias("_mx"))
    return (stacked.join(F.broadcast(maxima), "variable")
            .withColumn("scaled", F.col("value") / F.col("_mx") * F.lit(factor)).drop("_mx"))


def with_bins(df: DataFrame, lat: str | None = None, lon: str | None = None) -> DataFrame:
    """PRJ-4 on a grid: ``lat_bin``/``lon_bin`` (plus integer keys ``lat_key``/``lon_key`` for joins)."""
    lat = lat or resolve.first_containing(df.columns, "lat")
    lon = lon or resolve.first_containing(df.columns, "lon")
    return df.withColumns({"lat_bin": spatial_bin(F.col(lat)), "lon_bin": spatial_bin(F.col(lon)),
                           "lat_key": bin_index(F.col(lat)), "lon_key": bin_index(F.col(lon))})


def binned_means(df: DataFrame) -> DataFrame:
    """AGG-16 + SEL-6: mean of abundance/temperature columns per 0.1-degree bin."""
    b = with_bins(df)
    cols = resolve.abundance_or_temperature(df.columns)
    return b.groupBy("lat_key", "lon_key").agg(*[F.avg(c).alias(c) for c in cols])
