"""Exports as versions and replacement of single tables (SNK-1, SNK-3, SNK-4)."""
import os
import time

import pytest
from pyspark.sql import functions as F

from movegrid.operators import sinks, versions
from movegrid.plans import pipeline


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def publish(spark, root, **tables):
    with versions.Export(spark, root) as out:
        for name, n in tables.items():
            spark.range(n).write.parquet(out.folder(name))
    return out


def test_readers_see_whole_exports_only(spark, tmpdir_path):
    root = f"file://{tmpdir_path}/out"
    with pytest.raises(LookupError):
        versions.read(spark, root, "a")
    assert publish(spark, root, a=3, b=2).version == 1
    boom = F.udf(lambda i: 1 // (i - 7), "long")
    with pytest.raises(Exception):
        with versions.Export(spark, root) as out:
            spark.range(99).write.parquet(out.folder("a"))
            spark.range(50).select(boom("id")).write.parquet(out.folder("b"))      # dies in a task, after a was written
    assert versions.read(spark, root, "a").count() == 3 and versions.read(spark, root, "b").count() == 2
    with pytest.raises(FileNotFoundError):
        with versions.Export(spark, root) as out:
            out.folder("never_written")
    before = versions.read(spark, root, "a")
    assert publish(spark, root, a=5).version == 2
    assert versions.read(spark, root, "a").count() == 5 and versions.read(spark, root, "a", 1).count() == 3 and before.count() == 3
    with pytest.raises(KeyError):
        versions.read(spark, root, "b")
    assert rows(versions.history(spark, root).select("version", "table")) == [(1, "a"), (1, "b"), (2, "a")]


def test_two_exports_do_not_share_a_number(spark, tmpdir_path, monkeypatch):
    publish(spark, tmpdir_path, a=1)
    seen = versions.numbers
    monkeypatch.setattr(versions, "numbers", lambda store: seen(store)[:-1])        # as if the other had committed meanwhile
    with pytest.raises(versions.Conflict):
        publish(spark, tmpdir_path, a=9)
    monkeypatch.undo()
    assert versions.read(spark, tmpdir_path, "a").count() == 1 and versions.history(spark, tmpdir_path).count() == 1


def test_old_versions_and_leftovers_are_dropped(spark, tmpdir_path):
    for n in (1, 2, 3, 4):
        publish(spark, tmpdir_path, a=n)
    folders = os.path.join(tmpdir_path, "versions")
    for name, age in (("old_leftover", 48 * 3600), ("under_way", 0)):
        os.makedirs(os.path.join(folders, name))
        os.utime(os.path.join(folders, name), (time.time() - age,) * 2)
    assert len(versions.drop_old(spark, tmpdir_path, keep=2)) == 3
    assert len(os.listdir(folders)) == 3 and "under_way" in os.listdir(folders)
    assert versions.read(spark, tmpdir_path, "a").count() == 4 and versions.read(spark, tmpdir_path, "a", 3).count() == 3
    with pytest.raises(LookupError):
        versions.read(spark, tmpdir_path, "a", 2)
    assert publish(spark, tmpdir_path, a=6).version == 5
    with pytest.raises(ValueError):
        versions.drop_old(spark, tmpdir_path, keep=0)


def test_a_failed_overwrite_leaves_the_old_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    sinks.write_table(spark.range(4), path)
    boom = F.udf(lambda i: 1 // (i - 7), "long")
    with pytest.raises(Exception):
        sinks.write_table(spark.range(50).select(boom("id").alias("id")), path)
    assert spark.read.parquet(path).count() == 4 and os.listdir(tmpdir_path) == ["t"]
    sinks.write_table(spark.read.parquet(path).where("id > 0"), path)               # may even read what it replaces
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmpdir_path) == ["t"]


def test_pipeline_exports_are_versions(spark, tmpdir_path):
    a = pipeline.export({"track_summary": spark.range(3), "n": 5}, tmpdir_path)
    b = pipeline.export({"track_summary": spark.range(7)}, tmpdir_path)
    assert a["track_summary"] != b["track_summary"] and versions.read(spark, tmpdir_path, "track_summary").count() == 7
    with pytest.raises(ValueError):
        pipeline.export({"n": 5}, tmpdir_path)
