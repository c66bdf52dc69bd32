"""Calendar features of a timestamp column."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from movegrid.params import SEASON_BY_MONTH


def season(month: Column) -> Column:
    """Meteorological season of a month number; NULL stays NULL (no otherwise)."""
    by_season: dict[str, list[int]] = {}
    for m, s in SEASON_BY_MONTH.items():
        by_season.setdefault(s, []).append(m)
    expr = None
    for s, months in by_season.items():
        expr = F.when(month.isin(*months), F.lit(s)) if expr is None else expr.when(month.isin(*months), F.lit(s))
    return expr


def calendar_columns(ts: Column) -> dict[str, Column]:
    """year, month, day_of_year, ISO week, day_of_week (Monday=0), hour, season."""
    month = F.month(ts)
    return {
        "year": F.year(ts),
        "month": month,
        "day_of_year": F.dayofyear(ts),
        "week": F.weekofyear(ts),
        "day_of_week": F.weekday(ts),
        "hour": F.hour(ts),
        "season": season(month),
    }


def with_grid_calendar(df, time_col: str | None):
    """PRJ-3: year, month, day_of_year and season of the grid time column.

    The column is coerced to a timestamp when it is not one already
    (unparseable text becomes NULL).  Without a time column the table is returned as is.
    """
    if time_col is None:
        return df
    dtype = dict(df.dtypes)[time_col]
    ts = F.col(time_col)
    if not dtype.startswith("timestamp"):
        ts = ts.cast("string").try_cast("timestamp_ntz")   # wall-clock parse, NULL when invalid
        df = df.withColumn(time_col, ts)
        ts = F.col(time_col)
    month = F.month(ts)
    return df.withColumns({
        "year": F.year(ts),
        "month": month,
        "day_of_year": F.dayofyear(ts),
        "season": season(month),
    })


def days_between(earlier: Column, later: Column) -> Column:
    """Elapsed days as a double, exact to the microsecond and time-zone free."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(86400e6)
