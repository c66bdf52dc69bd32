import gzip
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from movegrid.llm import warc
from tests.llm.helpers import rows, sha

DDL = "page_id long, url string, html string, digest string, kind int"
BIG, OTHER = "<p>" + "x" * 200, "<p>" + "é" * 60
PAGES = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, "http://a/9\r\nX: y%41", BIG), (1, "u", "short"), (2, "u", "short"), (4, None, None), (6, "", ""),
         (7, "u7", OTHER), (8, "u8", OTHER), (None, "n", OTHER), (None, None, "<p>" + "z" * 100), (11, "a", "q" * 99), (12, "b", "q" * 99), (13, "c", "r" * 100), (14, "d", "r" * 100),
         (3, "http://a/3", BIG), (5, "other", BIG), (3, "third", "another page of the same id" * 9), (20, "long", "w" * 3_000_000)]


def run(spark, pages, **how):
    folder = tempfile.mkdtemp(prefix="warc-test-") + "/out"
    df = spark.createDataFrame([(*p, "x", 7) for p in pages], DDL)
    manifest = warc.write_warc(df, folder, **how)
    return folder, manifest, warc.read_warc(spark, manifest)


def brute(pages):
    first = {}
    for i, _, h in pages:
        h = h or ""
        if i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in pages:
        h = h or ""
        revisit = len(h.encode()) >= 100 and h in first and i != first[h]
        out.append((i, len(h.encode()), sha(h), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=repr)


def test_read_back_and_payloads(spark):
    _, _, records = run(spark, PAGES)
    assert sorted(rows(warc.read_back(records)), key=repr) == brute(PAGES)
    kept = rows(records.filter("record_type = 'response'").select("page_id", "url", "payload"))
    want = {(i, u, (h or "").encode()) for i, u, h in PAGES}
    assert all((i, u, bytes(p)) in want for i, u, p in kept)


def test_files_roll_and_manifest_lists_them(spark):
    pages = [(i, f"u{i}", os.urandom(600).hex()) for i in range(200)]
    folder, manifest, records = run(spark, pages, roll_bytes=20_000, shards=3)
    listed = pq.read_table(manifest).to_pylist()
    on_disk = sorted(f for f in os.listdir(folder + "/data") if not f.startswith("."))
    assert sorted(os.path.basename(x["file"]) for x in listed) == on_disk and len(on_disk) > 3
    assert not any(f.endswith(".tmp") for f in os.listdir(folder + "/data"))
    for x in listed:
        data = open(x["file"], "rb").read()
        assert sha(data) == x["sha256"] and len(data) == x["stored_bytes"]
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == x["records"]
        assert x["stored_bytes"] < 20_000 + 2_000
    assert records.count() == 200


def test_same_rows_give_same_bytes(spark):
    a, b = (run(spark, PAGES[::s], shards=2)[0] for s in (1, -1))
    names = sorted(os.listdir(a + "/data"))
    assert names == sorted(os.listdir(b + "/data"))
    assert all(open(f"{a}/data/{n}", "rb").read() == open(f"{b}/data/{n}", "rb").read() for n in names if not n.startswith("."))


def test_unlisted_files_are_not_read_and_damage_raises(spark):
    folder, _, records = run(spark, PAGES[:4], shards=1)
    open(folder + "/data/part-999999-00000.warc.gz", "wb").write(b"left over")
    assert records.count() == 4
    name = next(f for f in os.listdir(folder + "/data") if f.startswith("part-0000"))
    data = warc.record(1, "u", b"abc", sha("abc"), None, False, 0).replace(b"abc\r\n", b"abd\r\n")
    open(f"{folder}/data/{name}", "wb").write(gzip.compress(data))
    with pytest.raises(Exception, match="damaged record"):
        records.collect()


def test_empty_table(spark):
    assert rows(warc.read_back(run(spark, [])[2])) == []


def stored(folder):
    return {n: open(os.path.join(folder, "data", n), "rb").read() for n in sorted(os.listdir(os.path.join(folder, "data"))) if n.endswith(".gz")}


def test_files_do_not_depend_on_the_layout_and_are_read_by_many_tasks(spark):
    pages = PAGES + [(i, f"u{i}", os.urandom(40).hex() * 9) for i in range(100, 400)] + [(150, "again", "same id" * 40)] * 60
    folders = []
    for n in (1, 7):
        folder = tempfile.mkdtemp(prefix="warc-test-") + "/out"
        df = spark.createDataFrame([(*p, "x", 7) for p in (pages if n == 1 else pages[::-1])], DDL).repartition(n)
        records = warc.read_warc(spark, warc.write_warc(df, folder, shards=5, roll_bytes=12_000))
        assert sorted(rows(warc.read_back(records)), key=repr) == brute(pages)
        folders.append(stored(folder))
    assert folders[0] == folders[1] and len(folders[0]) > 8 and {n[:11] for n in folders[0]} == {f"part-{i:06d}" for i in range(5)}


def test_reading_is_spread_over_tasks(spark, monkeypatch):
    pages = [(i, f"u{i}", os.urandom(600).hex()) for i in range(200)]
    folder, manifest, _ = run(spark, pages, shards=4, roll_bytes=15_000)
    monkeypatch.setattr(warc, "READ_BYTES", 30_000)
    read = warc.read_warc(spark, manifest)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    held = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) >= 5 and sum(held) == 200 and max(held) <= 60
