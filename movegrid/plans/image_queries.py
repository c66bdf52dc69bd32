"""Image catalogue queries over the ``pages`` stand-in (url = path, html = bytes), and SQL twins."""
from __future__ import annotations

from movegrid.operators import images
from movegrid.params import PNG_COLOR_MODES
from movegrid.sources.standins import IMAGE_COLOURS, IMAGE_STEMS, image_files, whole_images

_stems = "[" + ", ".join(f"'{x}'" for x in IMAGE_STEMS) + "]"


def catalog(spark, sf_dir):
    return images.catalog(image_files(spark, sf_dir))


QUERIES = {
    "image_catalog": catalog,
    "image_gallery": lambda spark, sf_dir: images.gallery(catalog(spark, sf_dir)),
    "image_overlays": lambda spark, sf_dir: images.overlays(catalog(spark, sf_dir)),
    "image_integrity": lambda spark, sf_dir: images.integrity(whole_images(spark, sf_dir)),
    "image_readable": lambda spark, sf_dir: images.catalog(whole_images(spark, sf_dir), whole=True).select("filename", "width", "height", "mode", "size_bytes"),
    "image_counts": lambda spark, sf_dir: images.counts(catalog(spark, sf_dir)),
}

_species = " OR ".join(f"contains(lower(name), '{k}')" for k in images.IMAGE_SPECIES_KEYWORDS)
_env = " OR ".join(f"contains(lower(name), '{k}')" for k in images.IMAGE_ENV_KEYWORDS)

_colour = f"{IMAGE_COLOURS}[page_id % {len(IMAGE_COLOURS)} + 1]"
_mode = f"CASE {_colour} " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in PNG_COLOR_MODES.items()) + " END"

IMAGE_CTES = f"""
fl AS (
  SELECT path, string_split(path, '/')[-1] AS filename, content, width, height, mode
  FROM (SELECT page_id % 640 + 1 AS width, length(html) % 480 + 1 AS height, {_mode} AS mode, '/images/' || {_stems}[page_id % {len(IMAGE_STEMS)} + 1] || '_' || CAST(page_id AS VARCHAR) || '.png' AS path,
               unhex('89504E470D0A1A0A0000000D49484452' || printf('%08X', page_id % 640 + 1) || printf('%08X', length(html) % 480 + 1) || '08'
               || printf('%02X', {_colour}) || '00000000000000') || encode(html) AS content FROM pages WHERE page_id % 9 <> 0)),
ct AS (
  SELECT replace(filename, '.png', '') AS name, path, filename, content, width, height, mode FROM fl),
cat AS (
  SELECT name, CASE WHEN {_species} THEN 'plankton_species' WHEN {_env} THEN 'environmental' ELSE 'other' END AS category,
         path, filename, CAST(width AS BIGINT) AS width, CAST(height AS BIGINT) AS height, mode,
         CAST(octet_length(content) AS BIGINT) AS size_bytes, 'data:image/png;base64,' || to_base64(content) AS base64_data
  FROM ct)
"""


_TITLE = ("array_to_string(list_transform(string_split(replace(name, '_', ' '), ' '), "
          "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def _sql(body: str) -> str:
    return "WITH " + IMAGE_CTES.strip() + "\n" + body


_WHOLE = """
WITH f AS (
  SELECT page_id AS n, octet_length(encode(coalesce(html, ''))) AS html_bytes, octet_length(encode(coalesce(url, ''))) AS url_bytes,
         greatest(CAST(ceil(octet_length(encode(coalesce(html, ''))) / 4096) AS BIGINT), 1) AS pieces FROM pages),
w AS (SELECT *, 8 + 25 + 12 + url_bytes + 12 * pieces + html_bytes AS start, html_bytes - 4096 * (pieces - 1) + 12 AS last FROM f),
s AS (SELECT *, CASE (n % 6 + 6) % 6 WHEN 1 THEN start + 7 WHEN 3 THEN start + 15 WHEN 4 THEN html_bytes WHEN 5 THEN start ELSE start + 12 END AS size FROM w)
"""
ORACLE = {
    "image_integrity": _WHOLE + """
SELECT '/images/' || CAST(n AS VARCHAR) || '.png' AS path, ['ok', 'truncated', 'damaged', 'trailing', 'not_png', 'truncated'][(n % 6 + 6) % 6 + 1] AS status,
       CAST(CASE (n % 6 + 6) % 6 WHEN 0 THEN pieces + 3 WHEN 1 THEN pieces + 2 WHEN 2 THEN pieces + 1 WHEN 3 THEN pieces + 3 WHEN 4 THEN 0 ELSE pieces + 2 END AS BIGINT) AS n_chunks,
       CASE WHEN (n % 6 + 6) % 6 = 2 THEN 'IDAT' END AS bad_chunk,
       CAST(CASE (n % 6 + 6) % 6 WHEN 0 THEN start + 12 WHEN 2 THEN start - last WHEN 3 THEN start + 12 WHEN 4 THEN 0 ELSE start END AS BIGINT) AS "end",
       CAST(size AS BIGINT) AS size_bytes
FROM s""",
    "image_readable": _WHOLE + """
SELECT CAST(n AS VARCHAR) || '.png' AS filename, CAST(n % 640 + 1 AS BIGINT) AS width, CAST(n % 480 + 1 AS BIGINT) AS height, 'RGB' AS mode, CAST(size AS BIGINT) AS size_bytes
FROM s WHERE (n % 6 + 6) % 6 IN (0, 3)""",
    "image_catalog": _sql("SELECT * FROM cat"),
    "image_gallery": _sql(f"SELECT category, name, {_TITLE} AS display_name, filename, base64_data, size_bytes FROM cat"),
    "image_overlays": _sql(f"""
SELECT name, {_TITLE} AS display_name,
       CASE WHEN category = 'plankton_species' THEN 'plankton' ELSE 'environmental' END AS type, filename, base64_data,
       CAST(50 AS DOUBLE) AS south, CAST(1 AS DOUBLE) AS west, CAST(55 AS DOUBLE) AS north, CAST(5 AS DOUBLE) AS east
FROM cat WHERE category IN ('plankton_species', 'environmental')"""),
    "image_counts": _sql("""
SELECT count(*) AS total_images, count(*) FILTER (WHERE category = 'plankton_species') AS plankton_species,
       count(*) FILTER (WHERE category = 'environmental') AS environmental,
       count(*) FILTER (WHERE category = 'other') AS other
FROM cat"""),
}
