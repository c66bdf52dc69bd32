"""Tidy analysis report (SNK-5, AGG-28, AGG-31): (section, metric, value) rows built lazily."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from movegrid.functions.scalars import attach_one_row


def _rows(one_row: DataFrame, section: str, section_order: int, metrics: list[tuple[str, object]]) -> DataFrame:
    """Turn one aggregate row into report rows; values are formatted text."""
    arr = F.array(*[F.struct(F.lit(section).alias("section"), F.lit(section_order).alias("section_order"),
                             F.lit(name).alias("metric"), F.lit(i).alias("metric_order"),
                             expr.cast("string").alias("value"))
                    for i, (name, expr) in enumerate(metrics)])
    return one_row.select(F.inline(arr))


def _count(name: str):
    """A count with thousands separators."""
    return F.format_number(F.col(name).cast("long"), 0)


def track_section(raw_overview: DataFrame, clean_totals: DataFrame) -> DataFrame:
    """Raw counts are before cleaning, distance, speed and ranges after it (D25: named raw_/clean_).
    ``clean_totals`` is one aggregate of the cleaned fixes (``clean_overview``)."""
    degrees = lambda a, b: F.format_string("%.2f to %.2f", F.col(a), F.col(b))
    one = attach_one_row(raw_overview.drop("lat_min", "lat_max", "lon_min", "lon_max"), clean_totals)
    return _rows(one, "tracks", 1, [
        ("raw_records", _count("total_records")),
        ("raw_individuals", F.col("unique_ids")),
        ("date_from", F.date_format("date_min", "yyyy-MM-dd")),
        ("date_to", F.date_format("date_max", "yyyy-MM-dd")),
        ("clean_records", _count("clean_records")),
        ("clean_total_distance", F.format_string("%.2f", F.col("total_distance"))),
        ("clean_mean_speed", F.format_string("%.4f", F.col("avg_speed"))),
        ("clean_latitude", degrees("lat_min", "lat_max")),
        ("clean_longitude", degrees("lon_min", "lon_max")),
    ])


def clean_overview(clean: DataFrame) -> DataFrame:
    """AGG-3 + AGG-28: totals, count and coordinate ranges of the cleaned fixes in one pass."""
    return clean.agg(
        F.count(F.lit(1)).alias("clean_records"),
        F.coalesce(F.sum("distance"), F.lit(0.0)).alias("total_distance"),
        F.avg("speed").alias("avg_speed"),
        F.min("Latitude").alias("lat_min"), F.max("Latitude").alias("lat_max"),
        F.min("Longitude").alias("lon_min"), F.max("Longitude").alias("lon_max"),
    )


def grid_section(profile: DataFrame) -> DataFrame:
    return _rows(profile, "grid", 2, [
        ("records", _count("total_records")),
        ("files", F.col("unique_files")),
        ("abundance_variables", F.col("n_abundance_vars")),
        ("environmental_variables", F.col("n_env_vars")),
    ])


def catch_section(summary: DataFrame) -> DataFrame:
    return _rows(summary, "catch", 3, [
        ("species", F.col("unique_species")),
        ("areas", F.col("unique_areas")),
        ("total_catch", F.format_string("%.2f", F.col("total_catch"))),
        ("period_from", F.col("period_min")),
        ("period_to", F.col("period_max")),
    ])


def model_section(summary: DataFrame) -> DataFrame:
    return _rows(summary, "model", 4, [
        ("model_type", F.col("model_type")),
        ("r2", F.format_string("%.4f", F.col("r2"))),
        ("rmse", F.format_string("%.4f", F.col("rmse"))),
        ("mae", F.format_string("%.4f", F.col("mae"))),
        ("features", F.col("n_features")),
        ("cv_r2_mean", F.format_string("%.4f", F.col("cv_r2_mean"))),
        ("cv_r2_two_std", F.format_string("%.4f", F.col("cv_r2_two_std"))),
    ])


def assemble(sections: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), sections)
