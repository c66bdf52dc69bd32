"""Header CSV scans bound by name: the file's own columns are checked, then selected and cast.

Every column is read as text under the names in the file's header, so a swapped, added or missing
column is seen as what it is.  All files of a path must share one header; one that differs raises.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def scan_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text columns under the header's names, plus ``row_order``: the source order of a row as
    (file, place of its split in the file, place in the split), whatever order files are read in."""
    head = spark.read.option("header", True).csv(path).columns       # header lines only
    schema = StructType([StructField(c, StringType(), True) for c in head])
    rows = (spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
            .schema(schema).csv(path))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("row_order", place)


def require(df: DataFrame, required) -> DataFrame:
    """Raise when a required column is missing, naming it (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def number(text: Column, strict: bool = False) -> Column:
    """Text as a double; blank and NaN are missing.  Other text raises if ``strict``, else is missing."""
    plain = F.nullif(F.trim(text.cast("string")), F.lit(""))
    value = plain.cast("double") if strict else plain.try_cast("double")
    return F.when(~F.isnan(value), value)


def whole_number(text: Column, strict: bool = False) -> Column:
    """Text as an int; a whole number written as ``27.0`` counts, any other fraction does not."""
    value = number(text, strict)
    whole = F.when((value == F.floor(value)) & (F.abs(value) < F.lit(2.0 ** 31)), value.cast("int"))
    if not strict:
        return whole
    return F.when(value.isNotNull() & whole.isNull(), F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("int")).otherwise(whole)


def is_given(text: Column) -> Column:
    """Whether the text says something: neither missing, blank nor NaN."""
    plain = F.lower(F.trim(text.cast("string")))
    return F.coalesce((plain != "") & (plain != "nan"), F.lit(False))
