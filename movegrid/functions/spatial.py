"""Planar geometry on degrees and 0.1-degree bins."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def round_half_even(c: Column, decimals: int) -> Column:
    """Round like NumPy: scale, round half to even, unscale (bit-identical)."""
    scale = float(10 ** decimals)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def spatial_bin(c: Column, decimals: int = 1) -> Column:
    return round_half_even(c, decimals)


def bin_index(c: Column, decimals: int = 1) -> Column:
    """Integer bin key (``rint(x * 10**d)``): exact equality for joins on bins."""
    return F.rint(c * F.lit(float(10 ** decimals))).cast("long")


def planar_distance(dlat: Column, dlon: Column) -> Column:
    return F.sqrt(dlat * dlat + dlon * dlon)


def bearing_degrees(dlat: Column, dlon: Column) -> Column:
    """Clockwise from north, -180..180."""
    return F.atan2(dlon, dlat) * F.lit(180.0) / F.lit(math.pi)
