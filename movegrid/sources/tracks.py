"""Track sources (SRC-1, SRC-9)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movegrid.operators.tracks import REQUIRED
from movegrid.sources.text_tables import number, require, scan_text


def parse_tracks(raw: DataFrame, id_type: str | None = "long", strict: bool = True) -> DataFrame:
    """Typed fixes from text columns, bound by name; other columns are carried along as text.

    ``strict`` raises on a date, id or coordinate that can't be read; otherwise it becomes NULL.
    NaN coordinates are NULL (Spark keeps NaN distinct from NULL).
    """
    require(raw, REQUIRED)
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    date = F.to_timestamp_ntz(F.col("Date")) if strict else F.col("Date").try_cast("timestamp_ntz")
    return raw.withColumns({
        "id": cast(F.col("id"), id_type) if id_type else F.col("id"),
        "Date": date,
        "Latitude": number(F.col("Latitude"), strict),
        "Longitude": number(F.col("Longitude"), strict),
    })


def read_track_csv(spark: SparkSession, path: str | list[str], id_type: str | None = "long", strict: bool = True) -> DataFrame:
    """SRC-1: header CSV read by column name; required columns checked in the file; dates parsed.

    ``row_order`` is the source order for ties (D18): files by name, then lines.
    """
    return parse_tracks(scan_text(spark, path), id_type, strict)


def date_text_profile(raw: DataFrame) -> DataFrame:
    """SRC-9: rows and min/max of the unparsed Date text."""
    return require(raw, ["Date"]).agg(F.count(F.lit(1)).alias("rows"), F.min("Date").alias("date_text_min"),
                                      F.max("Date").alias("date_text_max"))


def raw_profile(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return date_text_profile(scan_text(spark, path))
