"""Image catalogue: categories from file names, PNG header fields, gallery and overlay tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from movegrid.functions.text import base_name, display_name
from movegrid.params import IMAGE_ENV_KEYWORDS, IMAGE_OVERLAY_BOUNDS, IMAGE_SPECIES_KEYWORDS, PNG_COLOR_MODES

PNG_SIGNATURE_HEX = "89504E470D0A1A0A"
DATA_URI_PREFIX = "data:image/png;base64,"


def category(stem: Column) -> Column:
    """IMG-1: species keywords win over environmental ones; otherwise 'other'."""
    low = F.lower(stem)
    species = None
    for k in IMAGE_SPECIES_KEYWORDS:
        c = low.contains(k)
        species = c if species is None else species | c
    env = None
    for k in IMAGE_ENV_KEYWORDS:
        c = low.contains(k)
        env = c if env is None else env | c
    return F.when(species, F.lit("plankton_species")).when(env, F.lit("environmental")).otherwise(F.lit("other"))


def _be_uint(content: Column, pos: int, n: int) -> Column:
    """Big-endian unsigned integer of ``n`` bytes at 1-based byte ``pos``."""
    return F.conv(F.hex(F.substring(content, pos, n)), 16, 10).cast("long")


def png_header(content: Column) -> dict[str, Column]:
    """IMG-2: width, height and mode from the IHDR chunk; NULL when the signature is not PNG."""
    ok = (F.hex(F.substring(content, 1, 8)) == F.lit(PNG_SIGNATURE_HEX)) & (F.octet_length(content) >= 29)
    color_type = _be_uint(content, 26, 1)
    mode = None
    for ct, m in PNG_COLOR_MODES.items():
        mode = F.when(color_type == ct, F.lit(m)) if mode is None else mode.when(color_type == ct, F.lit(m))
    return {
        "is_png": F.coalesce(ok, F.lit(False)),
        "width": F.when(ok, _be_uint(content, 17, 4)),
        "height": F.when(ok, _be_uint(content, 21, 4)),
        "mode": F.when(ok, mode),
    }


def walk(content: Column) -> Column:
    """IMG-2: a struct (status, n_chunks, bad_chunk, end) from a walk over a PNG's chunks.

    A chunk is a length, a type, as many bytes and the CRC-32 of type and bytes.  ``status`` is ``ok``; ``trailing`` where
    bytes follow the end chunk; ``truncated`` where the file ends before one; ``damaged`` where a checksum is wrong or the first
    chunk is no header (``bad_chunk`` is its type); or ``not_png``.  ``n_chunks`` counts the whole chunks before that, ``end`` the
    bytes up to there.  The walk has a step per chunk; a step after the end does nothing.

    ``content`` may be any expression: it is computed once, as the only element of an array, and not in every step.
    """
    return F.get(F.transform(F.array(content), _walk), F.lit(0))


def _walk(content: Column) -> Column:
    size, kinds = F.octet_length(content), "pos int, n_chunks int, status string, bad_chunk string"
    signed = F.hex(F.substring(content, 1, 8)) == F.lit(PNG_SIGNATURE_HEX)
    start = F.struct(F.lit(8).alias("pos"), F.lit(0).alias("n_chunks"), F.when(~F.coalesce(signed, F.lit(False)), F.lit("not_png")).alias("status"),
                     F.lit(None).cast("string").alias("bad_chunk")).cast(f"struct<{kinds.replace(' ', ':').replace(',:', ',')}>")
    part = lambda at, n: content.substr(at + 1, n)

    def step(s: Column, _: Column) -> Column:
        pos, left = s["pos"], size - s["pos"]
        length = F.conv(F.hex(part(pos, F.lit(4))), 16, 10).cast("long")
        name = part(pos + 4, F.lit(4)).cast("string")
        whole = (left >= 12) & (length <= left - 12)
        body = F.when(whole, length).otherwise(F.lit(0)).cast("int")
        right = F.conv(F.hex(part(pos + 8 + body, F.lit(4))), 16, 10).cast("long") == F.crc32(part(pos + 4, body + 4))
        first = (pos > 8) | ((name == "IHDR") & (length == 13))
        end = pos + 12 + body
        done = name == "IEND"
        sound = whole & right & first
        status = (F.when(~whole, F.lit("truncated")).when(~(right & first), F.lit("damaged"))
                  .when(done & (end < size), F.lit("trailing")).when(done, F.lit("ok")))
        moved = F.struct(F.when(sound, end).otherwise(pos).alias("pos"), (s["n_chunks"] + F.when(sound, 1).otherwise(0)).alias("n_chunks"),
                         status.alias("status"), F.when(whole & ~(right & first), name).alias("bad_chunk"))
        return F.when(s["status"].isNotNull(), s).otherwise(moved)

    steps = F.sequence(F.lit(0), F.greatest(F.floor((size - 8) / F.lit(12)).cast("int"), F.lit(0)))
    finish = lambda s: F.struct(F.coalesce(s["status"], F.lit("truncated")).alias("status"), s["n_chunks"].alias("n_chunks"),
                                s["bad_chunk"].alias("bad_chunk"), F.when(s["status"] == "not_png", 0).otherwise(s["pos"]).alias("end"))
    walked = F.aggregate(steps, start, step, finish)
    empty = F.struct(F.lit("not_png").alias("status"), F.lit(0).alias("n_chunks"), F.lit(None).cast("string").alias("bad_chunk"), F.lit(0).alias("end"))
    return F.when(content.isNull(), empty).otherwise(walked)


READABLE = ("ok", "trailing")


def integrity(files: DataFrame) -> DataFrame:
    """IMG-2: path, status, n_chunks, bad_chunk, end and size_bytes of every image file (path, content), readable or not."""
    walked = files.select("path", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("size_bytes"), walk(F.col("content")).alias("_w"))
    return walked.select("path", "_w.status", F.col("_w.n_chunks").cast("long").alias("n_chunks"), "_w.bad_chunk", F.col("_w.end").cast("long").alias("end"), "size_bytes")


def data_uri(content: Column) -> Column:
    """Base64 data URI; line breaks are removed so the text is the same whatever the session's
    base64 chunking setting."""
    return F.concat(F.lit(DATA_URI_PREFIX), F.regexp_replace(F.base64(content), "[\\r\\n]", ""))


def catalog(files: DataFrame, readable_only: bool = True, whole: bool = False) -> DataFrame:
    """SRC-7 + IMG-1 + IMG-2 + PRJ-16: one row per image file (path, content).

    ``readable_only`` skips files whose header is not PNG and, with ``whole``, also those whose chunks are damaged or end
    early (``integrity`` names them).
    """
    fname = base_name(F.col("path"))
    stem = F.replace(fname, F.lit(".png"), F.lit(""))

    def facts(content: Column) -> Column:
        hdr = png_header(content)
        return F.struct(hdr["width"].alias("width"), hdr["height"].alias("height"), hdr["mode"].alias("mode"),
                        F.octet_length(content).cast("long").alias("size_bytes"),
                        hdr["is_png"].alias("_png"), *([_walk(content)["status"].alias("_status")] if whole else []))

    # a row's facts are computed once, whatever its bytes are derived from; rules on them stay above the generator
    out = files.select("path", "content", F.inline(F.transform(F.array("content"), facts))).select(
        stem.alias("name"), category(stem).alias("category"), F.col("path"), fname.alias("filename"),
        "width", "height", "mode", "size_bytes", data_uri(F.col("content")).alias("base64_data"), "_png", *(["_status"] if whole else []))
    if readable_only:
        out = out.where(F.col("_png"))
    if readable_only and whole:
        out = out.where(F.col("_status").isin(*READABLE))
    if whole:
        out = out.drop("_status")
    return out.drop("_png")


def gallery(cat: DataFrame) -> DataFrame:
    """IMG-3: gallery rows for every category (``other`` included, D14)."""
    return cat.select("category", "name", display_name(F.col("name")).alias("display_name"), "filename",
                      "base64_data", "size_bytes")


def overlays(cat: DataFrame) -> DataFrame:
    """IMG-4: map overlay layers (plankton / environmental) with the fixed bounds."""
    south, west, north, east = IMAGE_OVERLAY_BOUNDS
    typ = F.when(F.col("category") == "plankton_species", F.lit("plankton")).otherwise(F.lit("environmental"))
    return (cat.where(F.col("category").isin("plankton_species", "environmental"))
            .select("name", display_name(F.col("name")).alias("display_name"), typ.alias("type"), "filename",
                    "base64_data", F.lit(south).alias("south"), F.lit(west).alias("west"),
                    F.lit(north).alias("north"), F.lit(east).alias("east")))


def counts(cat: DataFrame) -> DataFrame:
    """AGG-27: total and per-category image counts in one pass."""
    return cat.agg(
        F.count(F.lit(1)).alias("total_images"),
        F.count_if(F.col("category") == "plankton_species").alias("plankton_species"),
        F.count_if(F.col("category") == "environmental").alias("environmental"),
        F.count_if(F.col("category") == "other").alias("other"),
    )
