"""Types of CSV files with differing headers, against pandas (SRC-1, SRC-2)."""
import datetime as dt
import os

import pandas as pd
import pytest

from movegrid.sources import infer

A = '''id,Date,Latitude,note,flag,mixed,when
1,2021-08-01,50.5,"a, quoted ""x""",True,1,2021-08-01 10:00:00
2,2021-08-02,-1e-3,,False,2.5,2021-08-01T11:30:00
3,2021-08-03,NaN,NA,True,x,2021-08-01 10:00:00.250000
'''
B = """Latitude,id,depth,empty,note
51,4,7,,zz
 52 ,5,8,n/a,null
"""
C = """id,Latitude,big,id,,code
6,.5,9223372036854775808,1,q,007
"""


def save(folder, **files):
    for name, text in files.items():
        path = os.path.join(folder, name.replace("__", "/") + ".csv")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)


def test_types_equal_pandas(spark, tmpdir_path):
    save(tmpdir_path, a=A, sub__b=B, c=C)
    text = infer.read_text(spark, tmpdir_path)
    got = {r.column: r for r in infer.types(infer.profile(text.drop("file"))).collect()}
    frames = [pd.read_csv(os.path.join(tmpdir_path, p)) for p in ("a.csv", "sub/b.csv", "c.csv")]
    want = pd.concat(frames, ignore_index=True)
    assert set(got) == {*want.columns}
    for c, r in got.items():
        assert (r.n_rows, r.n_given) == (6, int(want[c].notna().sum())), c
        whole = all(f[c].dtype.kind == "i" or f[c].isna().all() for f in frames if c in f)
        kind = {"i": "whole", "u": "number", "f": "number", "b": "boolean", "O": "text"}[want[c].dtype.kind]
        if r.type == "missing":
            assert want[c].isna().all()
        elif r.type == "date":
            assert kind == "text" and pd.to_datetime(want[c].dropna(), format="ISO8601").notna().all()
        elif r.type == "whole":
            assert kind in ("whole", "number") and whole                 # pandas makes whole numbers with gaps floats
        elif r.type == "boolean":
            assert set(want[c].dropna()) <= {True, False}
        else:
            assert r.type == kind, c
    assert {c: r.type for c, r in got.items()} == {
        "id": "whole", "Date": "date", "Latitude": "number", "note": "text", "flag": "boolean", "mixed": "text", "when": "date", "depth": "whole",
        "empty": "missing", "big": "number", "id.1": "whole", "Unnamed: 4": "text", "code": "whole"}


def test_files_load_together(spark, tmpdir_path):
    save(tmpdir_path, a=A, sub__b=B)
    df = infer.read(spark, tmpdir_path)
    assert dict(df.dtypes) == {"id": "bigint", "Date": "timestamp_ntz", "Latitude": "double", "note": "string", "flag": "boolean", "mixed": "string",
                               "when": "timestamp_ntz", "depth": "bigint", "empty": "string", "file": "string"}
    rows = {r.id: r for r in df.collect()}
    assert rows[1].note == 'a, quoted "x"' and rows[1].Date == dt.datetime(2021, 8, 1) and rows[1].file == "a.csv" and rows[1].depth is None
    assert rows[3].Latitude is None and rows[3].note is None and rows[3].when == dt.datetime(2021, 8, 1, 10, 0, 0, 250000)
    assert rows[5].Latitude == 52.0 and rows[5].depth == 8 and rows[5].Date is None and rows[5].empty is None
    with pytest.raises(FileNotFoundError):
        infer.read(spark, tmpdir_path, "*.tsv")


def test_profiles_of_files_merge_to_that_of_all(spark, tmpdir_path):
    save(tmpdir_path, a=A, sub__b=B, c=C)
    text = infer.read_text(spark, tmpdir_path)
    key = lambda d: sorted(map(tuple, d.select("column", "kinds", "n_rows", "n_given").collect()))
    by_file = infer.profile(text, "file")
    assert by_file.where("column = 'depth'").count() == 3
    assert key(infer.merged(by_file)) == key(infer.profile(text.drop("file")))


def test_headers_survive_blank_lines_marks_and_line_ends(spark, tmpdir_path):
    save(tmpdir_path, a="\ufeffid,x\r\n1,2\r\n", b="\nid,x\n3,4\n")
    assert {r.header for r in infer.headers(spark, tmpdir_path).collect()} == {"id,x"}
    assert infer.names_of('a,"b,c",a,,a') == ["a", "b,c", "a.1", "Unnamed: 3", "a.2"]
    assert sorted(map(tuple, infer.read(spark, tmpdir_path, file_column=None).collect())) == [(1, 2), (3, 4)]
