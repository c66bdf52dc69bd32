"""Shared helpers for registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round selected double columns (multi-row sums differ in the last bits between engines)."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
