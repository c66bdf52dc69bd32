"""As-of join: for every row the latest row of another table at or before its time, within a key.

Both tables are laid into one and sorted by time within (key, chunk); a window carries the latest
row of the right side forward.  Chunks are those of long tracks: time slices, cut further where one
holds too many rows, so a hot key is spread over tasks.  What a chunk ends with is carried into the
chunks after it by a table of a row per (key, chunk).  No range is joined, nothing is multiplied.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from movegrid.operators.tracks import DEFAULT_CHUNK_DAYS, chunked


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str],
              tie: Column | None = None, chunk_days: float = DEFAULT_CHUNK_DAYS, heavy_rows: int | None = None,
              matched: str = "matched_time", tolerance_days: float | None = None) -> DataFrame:
    """JN-7: ``left`` with ``values`` of the latest row of ``right`` at or before its time among those equal in ``on``, and
    that row's time as ``matched``.

    Of right rows at one time that with the greatest ``tie`` (default: their values) is taken.  Rows of ``left``
    without a time or with a null key stay unmatched, as do those before the first right row and, with ``tolerance_days``,
    those whose match is older than that.  Right rows without a time or with a null key match nothing.  Every row of
    ``left`` comes back once; its columns must differ from ``values`` and ``matched``.
    """
    clash = set(left.columns) & {*values, matched}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*on, right_time]])
    value = F.struct(F.col(right_time).alias(matched), *values)
    key = F.struct(*on)
    # one row per key and time: many at one instant are merged before they meet the left side
    latest = right.where(known).groupBy(key.alias("_key"), F.col(right_time).alias("_ts")).agg(
        F.max_by(value, F.struct(*values) if tie is None else tie).alias("_value"))
    rows = left.select(key.alias("_key"), F.col(left_time).alias("_ts"), F.struct(*left.columns).alias("_row"))
    own, held = rows.schema["_row"].dataType, latest.schema["_value"].dataType
    seq = F.pmod(F.xxhash64("_row"), F.lit(1 << 40))          # the right row of an instant comes first, then left rows in any order
    both = rows.select("_key", "_ts", seq.alias("_seq"), "_row", F.lit(None).cast(held).alias("_value")).unionByName(
        latest.select("_key", "_ts", F.lit(-1).cast("long").alias("_seq"), F.lit(None).cast(own).alias("_row"), "_value"))
    cut = chunked(both, "_key", "_ts", "_seq", chunk_days, heavy_rows)
    order = Window.partitionBy("_key", "_chunk").orderBy(F.col("_ts").asc_nulls_last(), F.col("_seq")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = cut.withColumn("_near", F.last("_value", ignorenulls=True).over(order)).where(F.col("_row").isNotNull())
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("_key", "_chunk").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_ts"))).alias("_end"))
    carried = ends.select("_key", "_chunk", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    found = F.when(F.col("_ts").isNotNull(), F.coalesce("_near", "_carry"))
    if tolerance_days is not None:
        age = F.timestamp_diff("MICROSECOND", found[matched], F.col("_ts"))
        found = F.when(age <= F.lit(int(round(tolerance_days * 86400e6))), found)
    out = near.join(carried, ["_key", "_chunk"], "left").select("_row", found.alias("_found"))
    return out.select(*[F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_found")[c].alias(c) for c in [matched, *values]])
