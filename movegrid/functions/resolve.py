"""Name-based column resolution (pure driver-side functions over ``df.columns``).

These never run a job: they look at the schema only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, ShortType

from movegrid.params import (ENVIRONMENT_KEYWORDS, ENVIRONMENT_SUMMARY_KEYWORDS, PLANKTON_KEYWORDS,
                             PLANKTON_SUMMARY_KEYWORDS)


def columns_with_any(columns: list[str], keywords: list[str]) -> list[str]:
    """SEL-1/2/4: columns whose lower-cased name contains any keyword (column order kept)."""
    return [c for c in columns if any(k in c.lower() for k in keywords)]


def first_containing(columns: list[str], token: str) -> str | None:
    """SEL-3: first column whose lower-cased name contains ``token``."""
    for c in columns:
        if token in c.lower():
            return c
    return None


def plankton_columns(columns: list[str]) -> list[str]:
    return columns_with_any(columns, PLANKTON_KEYWORDS)


def environment_columns(columns: list[str]) -> list[str]:
    return columns_with_any(columns, ENVIRONMENT_KEYWORDS)


def variable_columns(columns: list[str], exclude: tuple[str, ...] = ()) -> list[str]:
    """SET-4: plankton + environmental variables, de-duplicated, order kept."""
    out: list[str] = []
    for c in plankton_columns(columns) + environment_columns(columns):
        if c not in out and c not in exclude:
            out.append(c)
    return out


def summary_plankton_columns(columns: list[str]) -> list[str]:
    return columns_with_any(columns, PLANKTON_SUMMARY_KEYWORDS)


def summary_environment_columns(columns: list[str]) -> list[str]:
    return columns_with_any(columns, ENVIRONMENT_SUMMARY_KEYWORDS)


def abundance_columns(columns: list[str], limit: int | None = None) -> list[str]:
    """SEL-5: columns with 'abundance' in the name, optionally the first ``limit``."""
    cols = [c for c in columns if "abundance" in c.lower()]
    return cols if limit is None else cols[:limit]


def abundance_or_temperature(columns: list[str]) -> list[str]:
    """SEL-6."""
    return [c for c in columns if "abundance" in c.lower() or "temperature" in c.lower()]


def numeric_columns(df: DataFrame, columns: list[str], parity: bool = False) -> list[str]:
    """SEL-7: numeric guard.  ``parity=True`` keeps only double/long (float32 is skipped, D12)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    allowed = (DoubleType, LongType) if parity else (DoubleType, LongType, FloatType, IntegerType, ShortType)
    return [c for c in columns if isinstance(types.get(c), allowed)]


def intersect_ordered(left: list[str], right: list[str]) -> list[str]:
    """SEL-9: ordered intersection of two column lists."""
    rs = set(right)
    return [c for c in left if c in rs]
