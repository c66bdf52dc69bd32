"""Sinks (SNK-1..7): tables, the wide raster, the text report, previews and shape profiles."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movegrid.operators.versions import replace


def write_table(df: DataFrame | None, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """SNK-1/3/4: write a processed table (Parquet by default, CSV with header on request).

    Refuses when there is nothing to write (``None``).  What lies at ``path`` is replaced when the new table is whole, not
    before.  With ``partition_by`` the rows are first
    rebalanced by those columns: Spark brings a partition's rows together and splits the large
    ones, so neither every task writes into every folder nor one task writes a whole hot folder."""
    if df is None:
        raise ValueError("no processed data to export")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w = w.option("header", True).format(fmt) if fmt == "csv" else w.format(fmt)
    return replace(df.sparkSession, path, w.save)


def write_wide_csv(wide: DataFrame, path: str) -> str:
    """SNK-2: the dense raster matrix as CSV with header (one row per latitude)."""
    return replace(wide.sparkSession, path, wide.write.option("header", True).csv)


def write_report(report: DataFrame, path: str) -> str:
    """SNK-5: the tidy report as text lines ``section | metric | value``.

    The report has a few dozen rows, so a single output file is bounded by construction.
    """
    line = F.concat_ws(" | ", "section", "metric", "value").alias("value")
    return replace(report.sparkSession, path, report.orderBy("section_order", "metric_order").select(line).coalesce(1).write.text)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """SNK-6."""
    return df.limit(n)


def shape_profile(df: DataFrame, name: str) -> DataFrame:
    """SNK-7: (table, n_rows, n_columns, columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("columns"))
