"""Catch statistics sources (SRC-2): fact table plus species and water-area dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movegrid.sources.text_tables import is_given, number, require, scan_text, whole_number

# FIXED VALUES - column names of the published files and the plain names used here
FACT_COLUMNS = {"SPECIES.ALPHA_3_CODE": "species_code", "AREA.CODE": "area_code", "PERIOD": "period", "VALUE": "value"}
SPECIES_COLUMNS = {"3A_Code": "species_code", "Name_En": "name_en", "Name_Fr": "name_fr", "Name_Es": "name_es",
                   "Scientific_Name": "scientific_name", "ISSCAAP_Group_En": "group_en"}
AREA_COLUMNS = {"Code": "code", "Name_En": "area_name", "Ocean_Group_En": "ocean_group",
                "InlandMarine_Group_En": "inland_marine_group"}


def _renamed(raw: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    require(raw, names)
    return raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in names.items()], *more)


def parse_capture(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed fact rows under plain names (dotted names need back-ticks everywhere else).

    Codes may be written ``27.0``; NaN and blank are missing.  Text that is no number raises if
    ``strict``; otherwise it is missing here and the row is listed by ``capture_rejects``.
    """
    out = _renamed(raw, FACT_COLUMNS, "row_order")
    return out.withColumns({
        "area_code": whole_number(F.col("area_code"), strict),
        "period": whole_number(F.col("period"), strict),
        "value": number(F.col("value"), strict),
    })


def capture_rejects(raw: DataFrame) -> DataFrame:
    """Fields that say something but can't be read, per column and text: (column, text, n_rows)."""
    out = _renamed(raw, FACT_COLUMNS)
    fields = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), read(F.col(c)).isNull().alias("bad"))
                       for c, read in (("area_code", whole_number), ("period", whole_number), ("value", number))])
    return (out.select(F.inline(fields)).where(F.col("bad") & is_given(F.col("text")))
            .groupBy("column", "text").agg(F.count(F.lit(1)).alias("n_rows")))


def read_capture(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    return parse_capture(scan_text(spark, path), strict)


def read_species(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _renamed(scan_text(spark, path), SPECIES_COLUMNS)


def read_areas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _renamed(scan_text(spark, path), AREA_COLUMNS).withColumn("code", whole_number(F.col("code"), strict=True))
