"""Attach one-row aggregates (global mean, max, min, count) to every row."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row of ``df``.

    The aggregate becomes a single uncorrelated scalar subquery (its columns packed into
    one struct): Spark runs it once and inlines the value, so there is no join at all.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_mg_s")).scalar()
    return (df.withColumn("_mg_s", packed)
            .select("*", *[F.col("_mg_s")[c].alias(c) for c in cols])
            .drop("_mg_s"))
