"""Image catalogue (IMG-1..4, D14, D15), sinks (SNK-1..7) and the end-to-end pipeline on small files."""
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from movegrid.operators import images, sinks, tracks
from movegrid.plans import pipeline, run_queries
from movegrid.sources.images import read_png_files
from tests.conftest import SF_SMALL


def png_bytes(width, height, color_type=6):
    ihdr = struct.pack(">IIBBBBB", width, height, 8, color_type, 0, 0, 0)
    chunk = struct.pack(">I", len(ihdr)) + b"IHDR" + ihdr + struct.pack(">I", zlib.crc32(b"IHDR" + ihdr))
    return b"\x89PNG\r\n\x1a\n" + chunk + b"\x00\x00\x00\x00IEND\xaeB`\x82"


def test_png_header_and_categories(spark):
    rows = [("/x/acartia_tonsa.png", bytearray(png_bytes(640, 480, 6))),
            ("/x/sea_temperature.png", bytearray(png_bytes(10, 20, 2))),
            ("/x/3d-map_overview.png", bytearray(png_bytes(1, 1, 0))),
            ("/x/truncated.png", bytearray(png_bytes(5, 5)[:12]))]
    files = spark.createDataFrame(rows, "path string, content binary")
    cat = {r.name: r for r in images.catalog(files).collect()}
    assert set(cat) == {"acartia_tonsa", "sea_temperature", "3d-map_overview"}     # unreadable skipped
    a = cat["acartia_tonsa"]
    assert (a.width, a.height, a.mode, a.category) == (640, 480, "RGBA", "plankton_species")
    assert cat["sea_temperature"].mode == "RGB" and cat["sea_temperature"].category == "environmental"
    assert cat["3d-map_overview"].category == "other"
    assert a.base64_data.startswith("data:image/png;base64,iVBORw0KGgo") and "\n" not in a.base64_data
    gal = {r.name: r.display_name for r in images.gallery(images.catalog(files)).collect()}
    assert gal["acartia_tonsa"] == "Acartia Tonsa" and gal["3d-map_overview"] == "3d-map Overview"   # D14, D15
    ov = images.overlays(images.catalog(files)).collect()
    assert {(r.name, r.type) for r in ov} == {("acartia_tonsa", "plankton"), ("sea_temperature", "environmental")}
    c = images.counts(images.catalog(files)).first()
    assert (c.total_images, c.plankton_species, c.environmental, c.other) == (3, 1, 1, 1)


def test_binary_file_scan(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "calanus.png"), "wb") as fh:
        fh.write(png_bytes(3, 4))
    with open(os.path.join(tmpdir_path, "notes.txt"), "w") as fh:
        fh.write("x")
    files = read_png_files(spark, tmpdir_path)
    cat = images.catalog(files).collect()
    assert [(r.name, r.width, r.height) for r in cat] == [("calanus", 3, 4)]
    assert read_png_files(spark, os.path.join(tmpdir_path, "missing")) is None


def test_sinks_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    p = sinks.write_table(df, os.path.join(tmpdir_path, "t"))
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "b")]
    c = sinks.write_table(df, os.path.join(tmpdir_path, "c"), fmt="csv")
    assert spark.read.option("header", True).csv(c).count() == 2
    with pytest.raises(ValueError):
        sinks.write_table(None, os.path.join(tmpdir_path, "none"))
    assert sinks.preview(df, 1).count() == 1
    prof = sinks.shape_profile(df, "t").first()
    assert (prof.n_rows, prof.n_columns) == (2, 2)


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_pipeline_end_to_end(spark, tmpdir_path):
    lines = ["id,Date,Latitude,Longitude"]
    for a in range(4):
        for d in range(1, 15):
            # on the sample grid's nodes, so every track bin has grid values
            lines.append(f"{a},2021-08-{d:02d} 12:00:00,{50 + (d - 1) * 5 / 19},{1 + (d - 1 + a) * 4 / 19},")
    lines = [l.rstrip(",") for l in lines]
    _write(os.path.join(tmpdir_path, "tracks.csv"), "\n".join(lines) + "\n")
    _write(os.path.join(tmpdir_path, "capture.csv"),
           "COUNTRY.UN_CODE,SPECIES.ALPHA_3_CODE,AREA.CODE,MEASURE,PERIOD,VALUE,STATUS\n"
           "1,BSH,27,Q_tlw,2000,10.5,A\n2,BSH,27,Q_tlw,2001,3,A\n3,COD,27,Q_tlw,2000,100,A\n4,RJC,88,Q_tlw,2000,7,A\n")
    _write(os.path.join(tmpdir_path, "species.csv"),
           "3A_Code,Name_En,Name_Fr,Name_Es,Scientific_Name,ISSCAAP_Group_En\n"
           "BSH,Blue shark,Peau bleue,Tiburón azul,Prionace glauca,\"Sharks, rays, chimaeras\"\n"
           "COD,Atlantic cod,Morue,Bacalao,Gadus morhua,\"Cods, hakes, haddocks\"\n"
           "RJC,Thornback ray,Raie bouclée,Raya de clavos,Raja clavata,\"Sharks, rays, chimaeras\"\n")
    _write(os.path.join(tmpdir_path, "areas.csv"),
           "Code,Name_En,Ocean_Group_En,InlandMarine_Group_En\n27,\"Atlantic, Northeast\",Atlantic,Marine areas\n"
           "88,\"Pacific, Antarctic\",Pacific,Marine areas\n")
    cfg = pipeline.Config(tracks_csv=os.path.join(tmpdir_path, "tracks.csv"), use_sample_grid=True,
                          capture_csv=os.path.join(tmpdir_path, "capture.csv"),
                          species_csv=os.path.join(tmpdir_path, "species.csv"),
                          areas_csv=os.path.join(tmpdir_path, "areas.csv"), target_area=None, resolution=5.0,
                          model_type="linear", work_dir=os.path.join(tmpdir_path, "work"), image_dir=os.path.join(tmpdir_path, "img"))
    os.makedirs(cfg.image_dir)
    with open(os.path.join(cfg.image_dir, "calanus.png"), "wb") as fh:
        fh.write(png_bytes(3, 4))
    out = pipeline.run(spark, cfg)
    assert {"sources", "track_overview", "track_date_text", "tracks_processed", "track_clean_accounting", "track_totals", "track_summary",
            "track_summary_report", "track_sampled", "track_endpoints", "track_polylines", "track_density", "movement_by_date",
            "records_by_month", "monthly_patterns", "distance_histogram", "map_center", "grid", "grid_profile", "grid_plankton_summary",
            "grid_env_summary", "grid_daily_abundance", "grid_positive_scaled", "catch_rejects", "catch_joined", "catch_summary",
            "top_species", "raster_cells", "raster_grid", "raster_stats", "raster_wide", "image_catalog", "image_counts", "image_gallery",
            "image_overlays", "image_integrity", "binned_features", "aligned_correlation", "feature_encodings", "model", "model_summary", "model_importance",
            "report"} == set(out)
    for name, df in out.items():
        if name not in ("model", "model_importance", "catch_rejects", "grid_positive_scaled"):   # no forest, rejects or positive values here
            assert not df.isEmpty(), name
    assert {(r.source, r.present, r.n_files) for r in out["sources"].collect()} == {("tracks", True, 1), ("grid", False, 0), ("catch", True, 3), ("images", True, 1)}
    assert out["track_endpoints"].count() == 4 and os.path.isdir(os.path.join(cfg.work_dir, "tracks_all", "year=2021"))
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, pipeline.Config(tracks_csv=os.path.join(tmpdir_path, "none.csv")))
    assert out["track_overview"].first().total_records == 56
    assert out["track_summary"].count() == 4
    s = out["catch_summary"].first()
    assert (s.unique_species, s.total_catch) == (2, 20.5)
    assert out["raster_stats"].first().total_distributed == pytest.approx(20.5)
    rep = {(r.section, r.metric): r.value for r in out["report"].collect()}
    assert rep[("tracks", "raw_records")] == "56" and ("model", "r2") in rep
    paths = pipeline.export({k: out[k] for k in ("track_summary", "tracks_processed", "raster_wide", "report")},
                            os.path.join(tmpdir_path, "out"))
    assert os.path.isdir(os.path.join(paths["tracks_processed"], "year=2021"))
    back = spark.read.parquet(paths["tracks_processed"])
    assert back.where(F.col("month") == 8).count() == out["tracks_processed"].count()
    text = spark.read.text(paths["report"]).collect()
    assert any(r.value.startswith("tracks | raw_records | 56") for r in text)


def test_pipeline_cross_validates_the_forest(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "tracks.csv")
    _write(path, "\n".join(["id,Date,Latitude,Longitude"] + [
        f"{a},2021-08-{d:02d} 12:00:00,{50 + (d - 1) * 5 / 19},{1 + (d - 1 + a) * 4 / 19}" for a in range(4) for d in range(1, 15)]) + "\n")
    out = pipeline.run(spark, pipeline.Config(tracks_csv=path, use_sample_grid=True))
    s, folds = out["model_summary"].first(), out["model_cv"].collect()
    assert sorted(f.fold for f in folds) == list(range(5)) and sum(f.n for f in folds) == s.training_samples
    assert all(f.r2 <= 1 and 0 <= f.mae <= f.rmse for f in folds)
    r2 = [f.r2 for f in folds]
    mean = sum(r2) / 5
    assert (s.cv_folds, s.cv_r2_mean, s.cv_r2_two_std) == (5, pytest.approx(mean), pytest.approx(2 * (sum((x - mean) ** 2 for x in r2) / 5) ** 0.5))
    imp = [(r.feature, r.importance) for r in out["model_importance"].collect()]
    assert sum(v for _, v in imp) == pytest.approx(1) and [v for _, v in imp] == sorted((v for _, v in imp), reverse=True)
    speeds = [r.speed for r in out["binned_features"].where("speed IS NOT NULL").collect()]
    pred = out["model_predictions"].collect()
    assert len(pred) == s.test_samples and all(min(speeds) <= p.prediction <= max(speeds) and p.residual == p.label - p.prediction for p in pred)
    rep = {(r.section, r.metric): r.value for r in out["report"].collect()}
    assert rep[("model", "cv_r2_mean")] == f"{s.cv_r2_mean:.4f}" and ("model", "cv_r2_two_std") in rep


def test_track_csv_strict_and_lenient_dates(spark, tmpdir_path):
    from movegrid.sources.tracks import raw_profile, read_track_csv
    path = os.path.join(tmpdir_path, "t.csv")
    _write(path, "id,Date,Latitude,Longitude\n1,2021-08-01 10:00:00,50.0,2.0\n1,not a date,50.1,NaN\n")
    lenient = read_track_csv(spark, path, strict=False).orderBy("row_order").collect()
    assert lenient[1].Date is None and lenient[1].Longitude is None          # NaN became NULL
    assert lenient[0].row_order < lenient[1].row_order
    with pytest.raises(Exception):
        read_track_csv(spark, path, strict=True).collect()
    prof = raw_profile(spark, path).first()
    assert (prof.rows, prof.date_text_min, prof.date_text_max) == (2, "2021-08-01 10:00:00", "not a date")


def test_track_csv_is_bound_by_name(spark, tmpdir_path):
    from movegrid.sources.tracks import read_track_csv
    path = os.path.join(tmpdir_path, "t.csv")
    _write(path, "id,Date,Depth,Longitude,Latitude\n1,2021-08-01,9,3.0,52.0\n")
    r = read_track_csv(spark, path).first()
    assert (r.Latitude, r.Longitude, r.Depth) == (52.0, 3.0, "9")            # swapped and extra columns
    missing = os.path.join(tmpdir_path, "m.csv")
    _write(missing, "id,Date,Latitude,Depth\n1,2021-08-01,52.0,9\n")
    with pytest.raises(ValueError, match="Longitude"):
        read_track_csv(spark, missing)
    mixed = os.path.join(tmpdir_path, "mixed")
    os.makedirs(mixed)
    _write(os.path.join(mixed, "a.csv"), "id,Date,Latitude,Longitude\n1,2021-08-01,52.0,3.0\n")
    _write(os.path.join(mixed, "b.csv"), "id,Date,Longitude,Latitude\n1,2021-08-02,3.0,52.0\n")
    with pytest.raises(Exception):
        read_track_csv(spark, mixed).collect()


def test_row_order_is_file_and_line_order(spark, tmpdir_path):
    from movegrid.operators import tracks
    from movegrid.sources.tracks import read_track_csv
    folder = os.path.join(tmpdir_path, "years")
    os.makedirs(folder)
    head = "id,Date,Latitude,Longitude\n"
    _write(os.path.join(folder, "2021.csv"), head + "1,2021-08-01,50.0,2.0\n")
    _write(os.path.join(folder, "2022.csv"), head + "".join(f"1,2021-08-01,{51 + i / 100},2.0\n" for i in range(30)))
    fixes = read_track_csv(spark, folder)
    assert [r.Latitude for r in fixes.orderBy("row_order").collect()] == [50.0] + [51 + i / 100 for i in range(30)]
    first = [r for r in tracks.process(fixes).collect() if r.lat_diff is None]
    assert [r.Latitude for r in first] == [50.0]                            # ties follow the source (D18)


def test_capture_codes_nan_and_rejects(spark, tmpdir_path):
    from movegrid.sources.catch import capture_rejects, read_capture
    from movegrid.sources.text_tables import scan_text
    path = os.path.join(tmpdir_path, "c.csv")
    _write(path, "SPECIES.ALPHA_3_CODE,AREA.CODE,PERIOD,VALUE\nBSH,27.0,2000,1.5\nBSH,27,2000,NaN\nBSH,27.5,2001,x\nBSH,,2002,\n")
    rows = [(r.area_code, r.period, r.value) for r in read_capture(spark, path).orderBy("row_order").collect()]
    assert rows == [(27, 2000, 1.5), (27, 2000, None), (None, 2001, None), (None, 2002, None)]
    assert sorted(tuple(r) for r in capture_rejects(scan_text(spark, path)).collect()) == [("area_code", "27.5", 1), ("value", "x", 1)]
    with pytest.raises(Exception):
        read_capture(spark, path, strict=True).collect()
    missing = os.path.join(tmpdir_path, "m.csv")
    _write(missing, "SPECIES.ALPHA_3_CODE,AREA.CODE,PERIOD\nBSH,27,2000\n")
    with pytest.raises(ValueError, match="VALUE"):
        read_capture(spark, missing)


def chunked_png(*bodies, name=b"IDAT"):
    chunk = lambda t, b: struct.pack(">I", len(b)) + t + b + struct.pack(">I", zlib.crc32(t + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 9, 8, 8, 2, 0, 0, 0)) + b"".join(chunk(name, b) for b in bodies) + chunk(b"IEND", b"")


def test_chunk_walk_names_what_is_wrong(spark):
    whole = chunked_png(b"a" * 1000, b"", b"b" * 70_000)
    flips = {i: whole[:i] + bytes([whole[i] ^ 4]) + whole[i + 1:] for i in (0, 20, 29, 60, 40_000, len(whole) - 2)}
    huge = whole[:33] + b"\xff\xff\xff\xff" + whole[37:]
    cases = {"ok": (whole, "ok", 5, None), "none": (None, "not_png", 0, None), "empty": (b"", "not_png", 0, None), "sig": (whole[:8], "truncated", 0, None),
             "cut": (whole[:-1], "truncated", 4, None), "half": (whole[:500], "truncated", 1, None), "tail": (whole + b"x", "trailing", 5, None),
             "flip0": (flips[0], "not_png", 0, None), "flip20": (flips[20], "damaged", 0, "IHDR"), "flip29": (flips[29], "damaged", 0, "IHDR"),
             "flip60": (flips[60], "damaged", 1, "IDAT"), "flip40000": (flips[40_000], "damaged", 3, "IDAT"), "crc": (flips[len(whole) - 2], "damaged", 4, "IEND"),
             "huge": (huge, "truncated", 1, None), "noheader": (b"\x89PNG\r\n\x1a\n" + whole[33:], "damaged", 0, "IDAT"), "html": (b"<html>" * 9, "not_png", 0, None),
             "many": (chunked_png(*[b""] * 5000), "ok", 5002, None)}
    files = spark.createDataFrame([(f"/i/{k}.png", None if v[0] is None else bytearray(v[0])) for k, v in cases.items()], "path string, content binary")
    got = {r.path[3:-4]: (r.status, r.n_chunks, r.bad_chunk) for r in images.integrity(files).collect()}
    assert got == {k: v[1:] for k, v in cases.items()}
    kept = {r.name for r in images.catalog(files, whole=True).collect()}
    assert kept == {k for k, v in cases.items() if v[1] in images.READABLE}
    assert images.integrity(files.limit(0)).count() == 0


def test_bytes_are_computed_once_however_they_are_derived(spark):
    """The catalogue's rules and the chunk walk take an image's bytes as given, not their derivation in every step."""
    header = images.PNG_SIGNATURE_HEX
    made = spark.range(3).select(F.concat(F.lit("/i/"), F.col("id").cast("string"), F.lit(".png")).alias("path"),
                                 F.unhex(F.concat(F.lit(header), F.sha2(F.col("id").cast("string"), 512))).alias("content"))
    for df in (images.catalog(made, whole=True), images.integrity(made), images.catalog(made, whole=True, readable_only=False)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("sha2(") == 1, plan
    assert [tuple(r) for r in images.integrity(made).select("status", "n_chunks").collect()] == [("truncated", 0)] * 3
    assert images.catalog(made, whole=True).count() == 0 and images.catalog(made, whole=True, readable_only=False).count() == 3


def test_run_over_files_reads_them_once(spark, monkeypatch):
    """The outputs of the run read its fixes and grid back from the tables written once, and heavy slices are looked for twice, not per output."""
    calls, real = [], tracks.chunked
    monkeypatch.setattr(tracks, "chunked", lambda *a, **k: calls.append(1) or real(*a, **k))
    out = run_queries.run(spark, SF_SMALL)
    for name in ("track_summary_report", "track_polylines", "track_sampled", "grid_daily_abundance"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan and "csv" not in plan and "MapInArrow" not in plan
    assert len(calls) == 2
    assert out["track_summary_report"].count() and out["track_polylines"].count() and out["image_catalog"].count() and read_png_files(spark, "/nowhere") is None
