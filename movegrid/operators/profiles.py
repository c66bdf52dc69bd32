"""Aggregate tables behind the maps, charts and dashboards (AGG-18..25, AGG-28/30, PRJ-17)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movegrid.functions.scalars import attach_one_row


def movement_by_date(df: DataFrame, ts: str = "Date", grain: str | None = None) -> DataFrame:
    """AGG-18: mean movement per timestamp (``grain='day'`` truncates to days, D7)."""
    if grain is None:
        key = F.col(ts)
    elif grain == "day":
        key = F.to_date(F.col(ts)).cast(dict(df.dtypes)[ts])     # wall-clock day, no time zone
    else:
        key = F.date_trunc(grain, F.col(ts)).cast(dict(df.dtypes)[ts])
    return df.groupBy(key.alias(ts)).agg(
        F.avg("distance").alias("avg_distance"),
        F.avg("speed").alias("avg_speed"),
        F.avg("Latitude").alias("avg_lat"),
        F.avg("Longitude").alias("avg_lon"),
    )


def records_by_month(df: DataFrame) -> DataFrame:
    """AGG-20."""
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("n_records"))


def monthly_patterns(df: DataFrame, id: str = "id") -> DataFrame:
    """AGG-21: monthly mean distance, mean speed and distinct entities."""
    return df.groupBy("month").agg(
        F.avg("distance").alias("avg_distance"),
        F.avg("speed").alias("avg_speed"),
        F.countDistinct(id).alias("n_ids"),
    )


def density(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude", decimals: int = 1) -> DataFrame:
    """AGG-25: fixes per spatial bin (the heat-map layer)."""
    from movegrid.functions.spatial import spatial_bin
    return (df.groupBy(spatial_bin(F.col(lat), decimals).alias("lat_bin"),
                       spatial_bin(F.col(lon), decimals).alias("lon_bin"))
            .agg(F.count(F.lit(1)).alias("n_points")))


def map_center(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """AGG-24: map centre."""
    return df.agg(F.avg(lat).alias("center_lat"), F.avg(lon).alias("center_lon"),
                  F.count(F.lit(1)).alias("n_points"))


def histogram(df: DataFrame, value: str, bins: int = 20, label: str = "n") -> DataFrame:
    """AGG-23: equal-width histogram with every bin present.

    Edges span [min, max]; the maximum falls in the last bin; when min = max the range is
    widened to [min - 0.5, max + 0.5] as NumPy does.  Output: bin, bin_lo, bin_hi, count.
    """
    stats = df.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    stats = stats.select(
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    )
    vals = attach_one_row(df.select(value).where(F.col(value).isNotNull()), stats)
    b = F.least(F.floor((F.col(value) - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))).cast("int"),
                F.lit(bins - 1))
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias(label))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_hi")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col(label), F.lit(0)).cast("long").alias(label)))
