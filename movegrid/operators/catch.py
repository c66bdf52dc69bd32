"""Catch facts x species x area: keyword species match, enrichment, totals, top-k.

Dimension joins carry no broadcast hint: Spark's size-based planning (file statistics,
then AQE's runtime shuffle sizes) broadcasts a dimension only when it is measured to be
small and falls back to a shuffled join otherwise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movegrid.functions.text import contains_any
from movegrid.params import ELASMOBRANCH_KEYWORDS, NORTH_SEA_AREA, SPECIES_SEARCH_COLUMNS


def match_species(species: DataFrame, keywords: list[str] = ELASMOBRANCH_KEYWORDS,
                  columns: list[str] = SPECIES_SEARCH_COLUMNS, whole_word: bool = False) -> DataFrame:
    """FIL-7/SET-3: species whose name columns contain any keyword (case-insensitive, NULL = no match).

    One alternation regex per column, OR-combined.  ``whole_word=True`` avoids
    substring over-matches such as 'ray' in 'crayfish' (D4).
    """
    cond = None
    for c in columns:
        m = contains_any(F.col(c), keywords, whole_word)
        cond = m if cond is None else cond | m
    return species.where(cond)


def enrich(facts: DataFrame, species: DataFrame, areas: DataFrame, marine_only: bool = True,
           marine_label: str | None = None) -> DataFrame:
    """JN-2 (inner, species), JN-3 (left, areas), PRJ-14, FIL-10.

    ``marine_only`` keeps rows whose area group is present (D3); ``marine_label`` narrows
    that to one label, e.g. 'Marine areas'.
    """
    sp = species.select("species_code", "name_en", "scientific_name", "group_en")
    ar = areas.select(F.col("code").alias("area_code"), "area_name", "ocean_group", "inland_marine_group")
    out = facts.join(sp, "species_code", "inner").join(ar, "area_code", "left")
    if marine_only:
        out = out.where(F.col("inland_marine_group").isNotNull())
    if marine_label is not None:
        out = out.where(F.col("inland_marine_group") == F.lit(marine_label))
    return out


def totals(df: DataFrame) -> DataFrame:
    """AGG-10: rows, period range and total value (0 when empty, D5)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("period").alias("period_min"),
        F.max("period").alias("period_max"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_value"),
    )


def summary(df: DataFrame) -> DataFrame:
    """AGG-26: distinct species and areas, total catch, period range (D8: intent, not the crash)."""
    return df.agg(
        F.countDistinct("species_code").alias("unique_species"),
        F.countDistinct("area_code").alias("unique_areas"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_catch"),
        F.min("period").alias("period_min"),
        F.max("period").alias("period_max"),
    )


def in_area(df: DataFrame, area) -> DataFrame:
    """FIL-8/FIL-9: rows of one area; the code is compared as an integer (D2)."""
    if area is None:
        return df
    return df.where(F.col("area_code") == F.lit(int(area)))


def area_period(df: DataFrame, target_area=None, order: str = "row_order") -> DataFrame:
    """AGG-11: per (area, period) total and the first non-missing names in source order (D6).

    Ties in ``order`` are broken by species code (names depend only on the species).
    """
    d = in_area(df, target_area)
    key = F.struct(F.col(order), F.col("species_code"))
    first_name = F.min_by(F.col("name_en"), F.when(F.col("name_en").isNotNull(), key))
    first_sci = F.min_by(F.col("scientific_name"), F.when(F.col("scientific_name").isNotNull(), key))
    return d.groupBy("area_code", "period").agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"),
        first_name.alias("name_en"),
        first_sci.alias("scientific_name"),
    )


def top_species(df: DataFrame, area=NORTH_SEA_AREA, n: int = 10) -> DataFrame:
    """AGG-12 + ORD-2: top ``n`` species of an area by total catch (ties by code)."""
    d = in_area(df, area)
    agg = d.groupBy("species_code", "name_en").agg(F.sum("value").alias("value"))
    return agg.orderBy(F.col("value").desc(), F.col("species_code").asc()).limit(n)
