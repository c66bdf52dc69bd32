"""States of files that come one by one against all files at once (AGG-5, AGG-18..21)."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from movegrid.operators import profiles, states, tracks

T0 = dt.datetime(2021, 8, 1)
SCHEMA = "id int, Date timestamp_ntz, Latitude double, Longitude double, row_order long"


def fixes(seed, start, days, n=200, ids=6, order=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        date = None if r.random() < .04 else T0 + dt.timedelta(days=start + r.random() * days)
        lat, lon = (None if r.random() < .03 else c + r.gauss(0, 2) for c in (52, 3))
        out.append((r.choice([*range(ids), None]), date, lat, lon, order + i))
    return out


def same(a, b):
    key = lambda t: tuple((x is None, x) for x in t)
    a, b = (sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=key) for df in (a, b))
    assert a == b and a


def whole(spark, parts):
    return tracks.clean(tracks.process(spark.createDataFrame([f for p in parts for f in p], SCHEMA), cumulative=False))


def compare(days, all_):
    same(states.summary_report(days), tracks.summary_report(all_))
    same(states.movement_by_day(days), profiles.movement_by_date(all_, grain="day"))
    same(states.monthly_patterns(days).select("month", "avg_distance", "avg_speed", "n_ids"), profiles.monthly_patterns(all_))
    same(states.monthly_patterns(days).select("month", "n_records"), profiles.records_by_month(all_))


def test_states_of_files_equal_all_files_at_once(spark, tmpdir_path):
    parts = [fixes(s, 12 * s, 12, order=1000 * s) for s in range(4)]
    table = states.StateTable(spark, os.path.join(tmpdir_path, "s"))
    for n in (2, 0, 3, 1):                                    # files may come in any order
        states.add_tracks(table, f"f{n}", spark.createDataFrame(parts[n], SCHEMA))
        if n == 0:
            compare(states.track_days(table), whole(spark, [parts[0], parts[2]]))
    compare(states.track_days(table), whole(spark, parts))


def test_adding_a_file_reads_that_file_only_and_adding_it_again_replaces_it(spark, tmpdir_path):
    paths = [os.path.join(tmpdir_path, f"fixes{n}") for n in range(2)]
    parts = [fixes(7, 0, 9), fixes(8, 9, 9, order=1000)]
    for p, rows in zip(paths, parts):
        spark.createDataFrame(rows, SCHEMA).write.parquet(p)
    table = states.StateTable(spark, os.path.join(tmpdir_path, "s"))
    states.add_tracks(table, "a", spark.read.schema(SCHEMA).parquet(paths[0]))
    os.rename(paths[0], paths[0] + "-away")                   # the first file can't be read any more
    assert states.add_tracks(table, "b", spark.read.schema(SCHEMA).parquet(paths[1])) == 2
    compare(states.track_days(table), whole(spark, parts))
    assert states.add_tracks(table, "b", spark.read.schema(SCHEMA).parquet(paths[1])) == 3
    compare(states.track_days(table), whole(spark, parts))
    boom = F.udf(lambda x: 1 // 0, "double")
    with pytest.raises(Exception):
        states.add_tracks(table, "c", spark.createDataFrame(parts[0], SCHEMA).withColumn("Latitude", boom("Latitude")))
    compare(states.track_days(table), whole(spark, parts))


def test_overlapping_files_are_named_and_recomputed(spark, tmpdir_path):
    parts = [fixes(1, 0, 20), fixes(2, 10, 20, order=1000), [(77, T0, 50.0, 2.0, 5000), (77, T0 + dt.timedelta(days=1), 51.0, 2.0, 5001)]]
    table = states.StateTable(spark, os.path.join(tmpdir_path, "s"))
    for n, p in enumerate(parts):
        states.add_tracks(table, f"f{n}", spark.createDataFrame(p, SCHEMA))
    assert {r.id for r in states.overlapping(table.read("edges")).collect()} == set(range(6))
    with pytest.raises(ValueError):
        states.track_days(table)
    everything = spark.createDataFrame([f for p in parts for f in p], SCHEMA)
    compare(states.track_days(table, lambda ids: everything.join(ids, "id", "left_semi")), whole(spark, parts))


def test_measures_merge_with_nulls_and_empty_sources(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", 4.0), ("b", 6.0)], "k string, v double")
    ms = [states.Measure("n", "rows"), states.Measure("c", "count", "v"), states.Measure("s", "sum", "v"), states.Measure("m", "mean", "v"),
          states.Measure("lo", "min", "v"), states.Measure("hi", "max", "v")]
    table = states.StateTable(spark, tmpdir_path)
    with pytest.raises(LookupError):
        table.read("x")
    for name, part in (("one", df.where("v = 1 OR v IS NULL")), ("two", df.where("v > 1")), ("none", df.limit(0))):
        table.add(name, {"x": states.partial(part, ["k"], ms)})
    got = {r.k: tuple(r)[1:] for r in states.values(states.merge(table.read("x"), ["k"], ms), ["k"], ms).collect()}
    assert got == {"a": (2, 1, 1.0, 1.0, 1.0, 1.0), "b": (3, 2, 10.0, 5.0, 4.0, 6.0)}
