"""String helpers: keyword alternations and display names."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def keyword_regex(keywords: list[str], whole_word: bool = False) -> str:
    """One case-insensitive (Unicode-aware) alternation for a keyword list."""
    alts = "|".join(re.escape(k) for k in keywords)
    body = rf"\b(?:{alts})\b" if whole_word else f"(?:{alts})"
    return "(?iu)" + body


def contains_any(col: Column, keywords: list[str], whole_word: bool = False) -> Column:
    """Case-insensitive substring match of any keyword; NULL counts as no match."""
    return F.coalesce(col.rlike(keyword_regex(keywords, whole_word)), F.lit(False))


def base_name(path: Column) -> Column:
    """PRJ-9: last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def display_name(stem: Column) -> Column:
    """PRJ-16: underscores to spaces, then title case (``initcap``; see README for D15)."""
    return F.initcap(F.regexp_replace(stem, "_", " "))
