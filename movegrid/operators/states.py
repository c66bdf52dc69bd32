"""Aggregates kept as mergeable states, so that new files need no rescan of the old ones.

A state is a row per group and source file that holds what its measures need: sums and counts for means, sums,
least and greatest values.  States of different files merge by adding; distinct ids are exact, as the id is part of the
group.  ``StateTable`` keeps them as versions (``versions``): adding a file reads that file only, adding it again replaces its
states, and a failed addition changes nothing.

Steps of a track depend on the fix before, so a track's file also keeps its first and last dated fix: the step from
one file to the next is made from these when states are merged.  Tracks whose files overlap in time can't be put together so;
they are named, and recomputed from their fixes alone.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from movegrid.functions.spatial import planar_distance, round_half_even
from movegrid.functions.temporal import days_between
from movegrid.operators import tracks, versions


@dataclass(frozen=True)
class Measure:
    """``kind`` of a ``column`` under a ``name``: rows, count, sum, mean, min or max."""

    name: str
    kind: str
    column: str = ""

    def states(self) -> list[tuple[str, Column, Callable[[str], Column]]]:
        """(state column, its value over rows, its value over states)."""
        if self.kind == "rows":
            return [(self.name, F.count(F.lit(1)), F.sum)]
        if self.kind == "count":
            return [(self.name, F.count(self.column), F.sum)]
        if self.kind == "mean":
            return [(f"{self.name}_sum", F.sum(self.column), F.sum), (f"{self.name}_n", F.count(self.column), F.sum)]
        over = {"sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return [(self.name, over(self.column), over)]

    def value(self) -> Column:
        return F.try_divide(F.col(f"{self.name}_sum"), F.col(f"{self.name}_n")) if self.kind == "mean" else F.col(self.name)


def partial(df: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """The states of ``df`` per group."""
    return df.groupBy(*keys).agg(*[over_rows.alias(name) for m in measures for name, over_rows, _ in m.states()])


def merge(states: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """States per coarser (or the same) group."""
    return states.groupBy(*keys).agg(*[over(name).alias(name) for m in measures for name, _, over in m.states()])


def values(states: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """What the merged states say."""
    return states.select(*keys, *[m.value().alias(m.name) for m in measures])


class StateTable:
    """Tables of states below a root, by source."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, source: str, tables: dict[str, DataFrame]) -> int:
        """Write the states of a source, in place of any that it has; the version."""
        tag = hashlib.sha256(source.encode()).hexdigest()[:24]
        with versions.Export(self.spark, self.root) as out:
            out.carry()
            for name, df in tables.items():
                df.withColumn("source", F.lit(source)).write.parquet(out.folder(f"{name}@{tag}"))
        return out.version

    def read(self, name: str) -> DataFrame:
        """The states ``name`` of all sources; LookupError where there are none."""
        paths = [path for table, (path, _) in versions.resolve(self.spark, self.root).items() if table.split("@")[0] == name]
        if not paths:
            raise LookupError(f"no states {name!r}")
        return self.spark.read.parquet(*sorted(paths))


# ---- tracks ------------------------------------------------------------------------------------

DAYS = [Measure("n", "rows"), Measure("dated", "count", "Date"), Measure("distance", "mean", "distance"), Measure("distance_max", "max", "distance"),
        Measure("speed", "mean", "speed"), Measure("speed_max", "max", "speed"), Measure("Latitude", "mean", "Latitude"),
        Measure("Longitude", "mean", "Longitude"), Measure("Date_min", "min", "Date"), Measure("Date_max", "max", "Date")]
KEYS = ["id", "day"]


def day_of(ts: str = "Date") -> Column:
    return F.to_date(F.col(ts)).alias("day")


def track_states(fixes: DataFrame, chunk_days: float | None = tracks.DEFAULT_CHUNK_DAYS) -> dict[str, DataFrame]:
    """``days`` and ``edges`` of a file of fixes (id, Date, Latitude, Longitude, row_order)."""
    kept = tracks.clean(tracks.process(fixes, chunk_days=chunk_days, cumulative=False))
    at = F.struct(F.col("Date").alias("ts"), F.col("row_order").alias("order"))
    fix = F.struct(F.col("Date").alias("ts"), F.col("row_order").alias("order"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    edges = fixes.where("id IS NOT NULL AND Date IS NOT NULL").groupBy("id").agg(F.min_by(fix, at).alias("first"), F.max_by(fix, at).alias("last"))
    return {"days": partial(kept, ["id", day_of()], DAYS), "edges": edges}


def _in_order(edges: DataFrame) -> DataFrame:
    """Edges with the last fix before each file's first, and whether some earlier file reaches beyond that first fix."""
    before = Window.partitionBy("id").orderBy("first", "source")
    at = lambda c: F.struct(F.col(f"{c}.ts"), F.col(f"{c}.order"))
    reached = F.max(at("last")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    return edges.select("*", F.lag("last").over(before).alias("_prior"), F.coalesce(reached > at("first"), F.lit(False)).alias("_over"))


def overlapping(edges: DataFrame) -> DataFrame:
    """The ids whose files overlap in time."""
    return _in_order(edges).where("_over").select("id").distinct()


def _bridges(edges: DataFrame) -> DataFrame:
    """The first fixes of files that follow another, with the step that leads to them, as ``tracks.process`` gives it."""
    first, prior = F.col("first"), F.col("_prior")
    lat_diff, lon_diff = first["lat"] - prior["lat"], first["lon"] - prior["lon"]
    distance, time_diff = planar_distance(lat_diff, lon_diff), days_between(prior["ts"], first["ts"])
    return _in_order(edges).where("_prior IS NOT NULL").select(
        "id", first["ts"].alias("Date"), first["lat"].alias("Latitude"), first["lon"].alias("Longitude"), distance.alias("distance"),
        time_diff.alias("time_diff"), (distance / F.nullif(time_diff, F.lit(0.0))).alias("speed"))


def add_tracks(table: StateTable, source: str, fixes: DataFrame) -> int:
    """Take a new file of fixes in; only ``fixes`` is read."""
    return table.add(source, track_states(fixes))


def track_days(table: StateTable, refetch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Merged states per id and day over all sources, equal to those of all fixes at once.

    ``refetch(ids)`` gives all fixes of the ids (a DataFrame of ``id``) whose files overlap in time; without it such ids raise.
    """
    days, edges = table.read("days"), table.read("edges")
    bridged = partial(tracks.clean(_bridges(edges)), ["id", day_of()], DAYS)
    over = overlapping(edges)
    if over.isEmpty():
        return merge(days.drop("source").unionByName(bridged), KEYS, DAYS)
    if refetch is None:
        raise ValueError("files of a track overlap in time; its fixes are needed to put them together")
    apart = lambda df: df.join(over, "id", "left_anti")
    again = track_states(refetch(over))["days"]
    return merge(reduce(DataFrame.unionByName, [apart(days.drop("source")), apart(bridged), again]), KEYS, DAYS)


def summary_report(days: DataFrame, decimals: int = 4) -> DataFrame:
    """AGG-5 from states: the same columns as ``tracks.summary_report``.  (The greatest distance from the centre of a track isn't
    mergeable: a new file moves the centre.)"""
    r = lambda c: round_half_even(c, decimals)
    v = merge(days, ["id"], DAYS)
    mean = {m.name: m.value() for m in DAYS}
    return v.select("id", r(F.coalesce("distance_sum", F.lit(0.0))).alias("distance_sum"), r(mean["distance"]).alias("distance_mean"),
                    r(F.col("distance_max")).alias("distance_max"), r(mean["speed"]).alias("speed_mean"), r(F.col("speed_max")).alias("speed_max"),
                    F.col("dated").alias("Date_count"))


def movement_by_day(days: DataFrame) -> DataFrame:
    """AGG-18 by day from states."""
    v = merge(days, ["day"], DAYS)
    mean = {m.name: m.value() for m in DAYS}
    return v.select(F.col("day").cast("timestamp_ntz").alias("Date"), mean["distance"].alias("avg_distance"), mean["speed"].alias("avg_speed"),
                    mean["Latitude"].alias("avg_lat"), mean["Longitude"].alias("avg_lon"))


def monthly_patterns(days: DataFrame) -> DataFrame:
    """AGG-20/21 from states: records, mean movement and distinct ids per month."""
    v = merge(days, ["id", F.month("day").alias("month")], DAYS)
    n_ids = v.groupBy("month").agg(F.count(F.lit(1)).alias("n_ids"))
    m = values(merge(v, ["month"], DAYS), ["month"], DAYS)
    return m.join(n_ids, "month").select("month", F.col("n").alias("n_records"), F.col("distance").alias("avg_distance"), F.col("speed").alias("avg_speed"), "n_ids")


# ---- grids -------------------------------------------------------------------------------------

def add_grid(table: StateTable, source: str, grid: DataFrame, columns: list[str], time: str = "time") -> int:
    """Take the cells of a new grid file in."""
    return table.add(source, {"times": partial(grid, [F.col(time).alias("time")], [Measure(c, "mean", c) for c in columns])})


def mean_by_time(table: StateTable, columns: list[str]) -> DataFrame:
    """AGG-19 from states: mean of every column per time step, over all sources."""
    measures = [Measure(c, "mean", c) for c in columns]
    return values(merge(table.read("times"), ["time"], measures), ["time"], measures)
