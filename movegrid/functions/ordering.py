"""Deterministic orderings: exact global row index, hash orders for samples/splits."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from movegrid.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = (partition id << 33) + position in partition


_MULT = 2654435761
_TWO32 = 4294967296
_TWO16 = 65536


def arithmetic_hash(key: Column, seed: int) -> Column:
    """Multiplicative hash ``(key * 2654435761 + seed) mod 2**32`` of a non-negative bigint key.

    Plain integer arithmetic, so any SQL engine computes the same order.  The product is
    formed from the 16-bit halves of ``key mod 2**32`` so no intermediate leaves the bigint
    range, whatever the key (the value equals the direct formula computed without overflow).
    """
    k = F.pmod(key.cast("long"), F.lit(_TWO32))
    hi, lo = F.floor(k / F.lit(_TWO16)).cast("long"), F.pmod(k, F.lit(_TWO16))
    mixed = F.pmod(hi * F.lit(_MULT), F.lit(_TWO16)) * F.lit(_TWO16) + lo * F.lit(_MULT) + F.lit(seed)
    return F.pmod(mixed, F.lit(_TWO32))


def with_global_index(df: DataFrame, order: list[Column], name: str = "row_index",
                      num_partitions: int | None = None) -> DataFrame:
    """Exact 0-based position of every row in the total order ``order`` (no single-task window).

    The rows are range-partitioned and sorted, each row is tagged with its partition and
    position, and the tagged table is checkpointed to the session's reliable checkpoint dir so
    that recomputation after an executor loss cannot renumber it.  Offsets come from the
    per-partition counts, a table bounded by the partition count, which is broadcast.
    ``order`` must be a total order (end it with a unique key).
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged.sortWithinPartitions(*order)
              .withColumn("_mg_pid", F.spark_partition_id())
              .withColumn("_mg_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_mg_pid").agg(F.count(F.lit(1)).alias("_mg_n"))
    offsets = counts.select(
        "_mg_pid",
        F.coalesce(F.sum("_mg_n").over(Window.orderBy("_mg_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_mg_off"))
    local_pos = F.col("_mg_mid") - F.shiftleft(F.col("_mg_pid").cast("long"), _POS_BITS)
    return (tagged.join(F.broadcast(offsets), "_mg_pid")
            .withColumn(name, F.col("_mg_off") + local_pos)
            .drop("_mg_pid", "_mg_mid", "_mg_off"))


def every_kth(df: DataFrame, order: list[Column], k: int, start: int = 0) -> DataFrame:
    """WIN-5: systematic sample, rows ``start, start+k, ...`` of the globally sorted table."""
    idx = with_global_index(df, order, "_mg_idx")
    return idx.where(F.pmod(F.col("_mg_idx") - F.lit(start), F.lit(k)) == 0).drop("_mg_idx")


def top_k_by_order(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """ORD-5: fixed-size sample as a deterministic top-k (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(n)


def with_running_total(df: DataFrame, order: list[Column], weight: str, name: str = "running_before") -> DataFrame:
    """Sum of ``weight`` over all rows before each row in the total order ``order``.

    As ``with_global_index``: ranges are numbered once (checkpointed), offsets come from the
    per-range sums (bounded by the number of ranges), and the sums inside a range are windowed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.repartitionByRange(*order).withColumn("_mg_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("_mg_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("_mg_pid").agg(F.sum(weight).alias("_mg_n")).select(
        "_mg_pid", F.coalesce(F.sum("_mg_n").over(before), F.lit(0)).alias("_mg_off"))
    inside = Window.partitionBy("_mg_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("_mg_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(F.broadcast(offsets), "_mg_pid")
            .withColumn(name, F.col("_mg_off") + F.col("_mg_in")).drop("_mg_pid", "_mg_in", "_mg_off"))


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact medians of several columns as one row (``_med_<col>``), without one-task merges.

    Non-NULL values of all columns are stacked as (variable, value) and counted first, so that
    equal values, however many, are one row; running totals of the counts in the order
    (variable, value) then give the rows that hold the middle places.  An even count interpolates
    ``lo + 0.5 * (hi - lo)``.  A column without values gets NULL.
    """
    spark = df.sparkSession
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("v"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)
    ])).alias("_s")).select("_s.v", "_s.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    counted = stacked.groupBy("v", "x").agg(F.count(F.lit(1)).alias("n"))
    totals = with_running_total(counted, [F.col("v"), F.col("x")], "n", "_before")
    bounds = totals.groupBy("v").agg(F.min("_before").alias("_start"), F.sum("n").alias("_n"))  # one row per column
    held = lambda place: (F.col("_before") <= place) & (place < F.col("_before") + F.col("n"))
    low = F.col("_start") + F.floor((F.col("_n") - 1) / 2)
    high = F.col("_start") + F.ceil((F.col("_n") - 1) / 2)
    mid = totals.join(F.broadcast(bounds), "v").where(held(low) | held(high))
    per_var = mid.groupBy("v").agg((F.min("x") + F.lit(0.5) * (F.max("x") - F.min("x"))).alias("m"))
    names = spark.range(len(columns)).select(F.col("id").cast("int").alias("v"))
    full = names.join(per_var, "v", "left")
    return full.agg(*[F.max(F.when(F.col("v") == i, F.col("m"))).alias(f"_med_{c}") for i, c in enumerate(columns)])
