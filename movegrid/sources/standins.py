"""Stand-in views: the domain tables expressed over the shared benchmark tables.

The benchmark tables have no tracks, grids or catch files, so each domain table is
derived from one of them with plain column arithmetic.  The same definitions exist as
SQL text beside the queries in ``movegrid.plans`` so a second engine can check every query.
Constants keep derived coordinates off rounding midpoints.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movegrid.params import ELASMOBRANCH_KEYWORDS

# FIXED VALUES — area code given to nation keys 0..20 (21..24 map to key - 20, unknown areas)
NATION_AREA_CODES = [18, 21, 27, 31, 34, 37, 41, 47, 48, 51, 57, 58, 61, 67, 71, 77, 81, 87, 88, 98, 99]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one shared table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def track_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks (id, Date, Latitude, Longitude, row_order) from ``events``."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).try_cast("int")
    return ev.select(
        F.col("user_id").alias("id"),
        F.col("ts").alias("Date"),
        (F.lit(50.0131) + F.lit(0.047) * k).alias("Latitude"),
        (F.lit(1.0037) + F.col("value") / F.lit(25)).alias("Longitude"),
        F.col("event_id").alias("row_order"),
    )


def track_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks as a file would hold them: text, columns in another order, an extra column, and
    some dates and coordinates that can't be read."""
    tp = track_points(spark, sf_dir)
    n = F.col("row_order")
    date = F.date_format("Date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return tp.select(
        F.when(n % 30 == 0, F.lit("east")).otherwise(F.col("Longitude").cast("string")).alias("Longitude"),
        F.concat(F.lit("n"), n.cast("string")).alias("note"),
        F.when(n % 50 == 0, F.lit("unknown")).otherwise(date).alias("Date"),
        F.when(n % 40 == 0, F.lit("NaN")).otherwise(F.col("Latitude").cast("string")).alias("Latitude"),
        F.col("id").cast("string").alias("id"), "row_order")


def catch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catch facts as a file would hold them: published column names, codes written as 27.0,
    some values NaN and some fields that can't be read."""
    cf = catch_facts(spark, sf_dir)
    n = F.col("row_order")
    return cf.select(
        F.when(n % 20 == 0, F.lit("NaN")).when(n % 21 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("VALUE"),
        F.when(n % 3 == 0, F.concat(F.col("area_code").cast("string"), F.lit(".0"))).when(n % 50 == 1, F.lit("27.5"))
        .otherwise(F.col("area_code").cast("string")).alias("AREA.CODE"),
        F.lit("x").alias("STATUS"), F.col("period").cast("string").alias("PERIOD"),
        F.col("species_code").cast("string").alias("SPECIES.ALPHA_3_CODE"), "row_order")


def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-format grid rows with three 'files' from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("time"),
        (F.lit(50.0131) + F.lit(0.047) * (F.col("l_partkey") % 100)).alias("latitude"),
        (F.lit(1.0037) + F.lit(0.04) * (F.col("l_suppkey") % 100)).alias("longitude"),
        (F.col("l_extendedprice") / F.lit(100)).alias("acartia_abundance"),
        (F.col("l_quantity") - F.lit(25)).alias("calanus_abundance"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("metridia_abundance"),
        (F.col("l_tax") * F.lit(100)).alias("temperature"),
        (F.lit(35) - F.col("l_discount") * F.lit(10)).alias("salinity"),
        F.concat(F.lit("grid_"), F.col("l_returnflag"), F.lit(".nc")).alias("file_source"),
        (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("l_suppkey")).alias("row_order"),
        F.col("l_partkey").alias("row_tiebreak"),
    )


def timed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid rows whose times lie in the weeks of the fixes: whole hours of January 2024, some without a time."""
    gp = grid_points(spark, sf_dir)
    hour = F.col("row_order") % 690
    time = F.timestamp_add("HOUR", hour, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return gp.withColumn("time", F.when(F.col("row_order") % 29 != 0, time)).select(
        "time", "latitude", "longitude", "acartia_abundance", "temperature", (F.col("row_order") * 100000 + F.col("row_tiebreak")).alias("row_order"))


def undated_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixes, every 31st without a time and every 37th without a latitude."""
    tp, n = track_points(spark, sf_dir), F.col("row_order")
    return tp.withColumns({"Date": F.when(n % 31 != 0, F.col("Date")), "Latitude": F.when(n % 37 != 0, F.col("Latitude"))})


def _area_code(nationkey):
    mapped = F.element_at(F.array(*[F.lit(c) for c in NATION_AREA_CODES]), nationkey + 1)
    return F.when(nationkey <= 20, mapped).otherwise(nationkey - 20)


def catch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catch facts (species_code, area_code, period, value, row_order) from lineitem x orders x supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(su, li.l_suppkey == su.s_suppkey)
    return j.select(
        F.col("l_partkey").alias("species_code"),
        _area_code(F.col("s_nationkey")).cast("int").alias("area_code"),
        F.year("o_orderdate").alias("period"),
        F.col("l_quantity").alias("value"),
        (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("l_suppkey")).alias("row_order"),
    )


def species_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species dimension from ``part``; some names hold domain words, in any case and script."""
    p = table(spark, sf_dir, "part")
    nth = F.col("p_partkey") % 13
    named = lambda k, text, plain: F.when(nth == k, F.concat(F.lit(text), plain)).otherwise(plain)
    return p.select(
        F.col("p_partkey").alias("species_code"),
        named(0, "Blue SHARK ", F.col("p_name")).alias("name_en"),
        F.when(F.col("p_partkey") % 7 != 0, named(6, "CHIMÈRE ", F.col("p_brand"))).alias("name_fr"),
        named(4, "TIBURÓN ", F.col("p_brand")).alias("name_es"),
        named(2, "Полярная АКУЛА ", F.col("p_type")).alias("scientific_name"),
        named(8, "鲨鱼 ", F.concat(F.lit("GROUP "), (F.col("p_size") % 10).cast("string"))).alias("group_en"),
    )


def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords (keyword): the fixed list, and a brand's name for every customer number, most of which no species has."""
    fixed = spark.createDataFrame([(k,) for k in ELASMOBRANCH_KEYWORDS], "keyword string")
    return fixed.unionByName(table(spark, sf_dir, "customer").select(F.concat(F.lit("Brand#"), F.col("c_custkey").cast("string")).alias("keyword")))


def area_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water-area dimension from nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        _area_code(nk).cast("int").alias("code"),
        F.col("n_name").alias("area_name"),
        F.col("r_name").alias("ocean_group"),
        F.when(nk <= 20, F.lit("Marine areas")).when(nk <= 23, F.lit("Inland waters")).alias("inland_marine_group"),
    )


def area_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes (area_id, lat_min, lat_max, lon_min, lon_max) from ``customer``: sides from 0.02 degrees to most of the globe,
    some over the antimeridian, some upside down and some without a bound."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    side = F.element_at(F.array(*[F.lit(x) for x in (0.02, 0.05, 0.1, 0.3)]), (k % 4 + 1).cast("int"))
    lat, lon = F.lit(49.9007) + F.lit(0.0331) * (k % 151), F.lit(0.9011) + F.lit(0.0271) * (k % 163)
    wide, over = k % 100 == 0, k % 101 == 0
    return c.select(
        k.alias("area_id"), F.when(k % 103 == 0, lat + 1).when(wide, F.lit(-60.0)).otherwise(lat).alias("lat_min"),
        F.when(k % 107 != 0, lat + side).alias("lat_max"), F.when(over, F.lit(2.9003)).otherwise(lon).alias("lon_min"),
        F.when(over, F.lit(-170.0)).when(wide, F.lit(170.0)).otherwise(lon + side).alias("lon_max"))


def area_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons (area_id, ring) from ``customer``: a dart of four points, not convex, of 0.1 to 0.7 degrees."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    lat, lon, side = F.lit(50.0007) + F.lit(0.0293) * (k % 157), F.lit(1.0011) + F.lit(0.0251) * (k % 149), F.lit(0.1) * (k % 7 + 1)
    point = lambda y, x: F.struct((lat + side * F.lit(y)).alias("lat"), (lon + side * F.lit(x)).alias("lon"))
    return c.select(k.alias("area_id"), F.array(point(0.0, 0.0), point(0.4, 0.5), point(0.0, 1.0), point(1.0, 0.5)).alias("ring"))


# FIXED VALUES — stand-in image name stems (two species, two environmental, two other)
IMAGE_STEMS = ["acartia_tonsa", "calanus_finmarchicus", "sea_surface_temperature", "salinity_map",
               "bathymetry", "3d-map_overview"]


# FIXED VALUES — PNG colour types in the order the stand-in images cycle through them
IMAGE_COLOURS = [0, 2, 3, 4, 6]


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image-file rows (path, content) from ``pages``: every page becomes one file whose name
    stem cycles through ``IMAGE_STEMS`` by page id.  Its bytes are a PNG header with the page's
    size fields and then the html; every ninth file is html only, so no image."""
    pg = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    stem = F.element_at(F.array(*[F.lit(x) for x in IMAGE_STEMS]), (n % len(IMAGE_STEMS) + 1).cast("int"))
    field = lambda value, digits: F.lpad(F.hex(value.cast("long")), digits, "0")
    colour = F.element_at(F.array(*[F.lit(x) for x in IMAGE_COLOURS]), (n % len(IMAGE_COLOURS) + 1).cast("int"))
    header = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), field(n % 640 + 1, 8), field(F.length("html") % 480 + 1, 8),
                              F.lit("08"), field(colour, 2), F.lit("00000000000000")))
    html = F.col("html").cast("binary")
    return pg.select(
        F.concat(F.lit("/images/"), stem, F.lit("_"), n.cast("string"), F.lit(".png")).alias("path"),
        F.when(n % 9 == 0, html).otherwise(F.concat(header, html)).alias("content"),
        n.alias("row_order"),
    )


def whole_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG files (path, content, row_order) from ``pages`` with all their chunks: header, the url as text, the html in data chunks of up
    to 4,096 bytes, and the end.  Of six files one each is cut short, has a wrong checksum in its last data chunk, has bytes
    after its end, is no PNG, or lacks the end chunk."""
    pg = table(spark, sf_dir, "pages")
    n, kind = F.col("page_id"), F.pmod(F.col("page_id"), F.lit(6))
    data, url = F.coalesce(F.col("html"), F.lit("")).cast("binary"), F.coalesce(F.col("url"), F.lit("")).cast("binary")
    number = lambda value: F.lpad(F.hex(value.cast("long")), 8, "0")

    def chunk(name: str, body, wrong=F.lit(0)):
        typed = F.concat(F.lit(name).cast("binary"), body)
        return F.concat(number(F.octet_length(body)), F.hex(typed), number(F.crc32(typed).bitwiseXOR(wrong.cast("long"))))

    pieces = F.greatest(F.ceil(F.octet_length(data) / F.lit(4096)), F.lit(1)).cast("int")
    last = lambda i: F.when((i == pieces - 1) & (kind == 2), F.lit(1)).otherwise(F.lit(0))
    body = F.array_join(F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: chunk("IDAT", data.substr(i * 4096 + 1, F.lit(4096)), last(i))), "")
    header = F.unhex(F.concat(number(n % 640 + 1), number(n % 480 + 1), F.lit("0802000000")))
    start = F.concat(F.lit("89504E470D0A1A0A"), chunk("IHDR", header), chunk("tEXt", url), body)
    whole = F.concat(start, chunk("IEND", F.lit("").cast("binary")))
    content = (F.when(kind == 1, F.expr("substring(w, 1, length(w) - 10)")).when(kind == 3, F.concat(F.col("w"), F.lit("00FF00"))).when(kind == 4, F.hex(data))
               .when(kind == 5, F.expr("substring(w, 1, length(w) - 24)")).otherwise(F.col("w")))
    return pg.withColumn("w", whole).select(F.concat(F.lit("/images/"), n.cast("string"), F.lit(".png")).alias("path"), F.unhex(content).alias("content"), n.alias("row_order"))


def netcdf_grids(spark: SparkSession, sf_dir: str, steps: int = 10) -> DataFrame:
    """Grid files to be (name, slabs) from ``array_grid``: ``steps`` consecutive one-step files become one file
    with a time axis; a variable that a step lacks is missing there."""
    variables = ["acartia_abundance", "temperature", "salinity"]
    no = F.regexp_extract("file_source", "[0-9]+", 0).cast("long")
    one = array_grid(spark, sf_dir).select(no.alias("step"), "variable", F.col("time")[0].alias("day"), "lat", "lon", "values")
    none = F.array_repeat(F.lit(None).cast("double"), 64)
    per_step = one.groupBy("step", "day", "lat", "lon").agg(
        *[F.coalesce(F.max(F.when(F.col("variable") == v, F.col("values"))), none).alias(v) for v in variables])
    per_file = per_step.groupBy(F.floor(F.col("step") / steps).alias("file"), "lat", "lon").agg(F.sort_array(F.collect_list(F.struct("step", "day", *variables))).alias("held"))
    slab = lambda v: F.struct(F.lit(v).alias("variable"), F.col("held.day").alias("time"), "lat", "lon", F.flatten(F.col(f"held.{v}")).alias("values"))
    return per_file.select(F.concat(F.lit("emb_"), F.col("file").cast("string"), F.lit(".nc")).alias("name"), F.array(*map(slab, variables)).alias("slabs"))


def array_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-encoded grid slabs from ``embeddings``.

    Three consecutive vectors form one "file" holding three variables over the same
    one-step 8 x 8 grid.  Layout: file_source, variable, time ARRAY, lat ARRAY, lon ARRAY,
    values ARRAY<DOUBLE> with ``flat_index = (t * n_lat + y) * n_lon + x``.
    """
    e = table(spark, sf_dir, "embeddings")
    file_no = F.floor(F.col("vec_id") / 3).cast("long")
    var = F.element_at(F.array(F.lit("acartia_abundance"), F.lit("temperature"), F.lit("salinity")),
                       (F.col("vec_id") % 3 + 1).cast("int"))
    axis = F.sequence(F.lit(0), F.lit(7))
    day = F.date_add(F.lit("2021-08-01").cast("date"), (file_no % 61).cast("int"))
    return e.select(
        F.concat(F.lit("emb_"), file_no.cast("string"), F.lit(".nc")).alias("file_source"),
        var.alias("variable"),
        F.array(day.cast("timestamp_ntz")).alias("time"),
        F.transform(axis, lambda i: F.lit(50.0131) + F.lit(0.047) * i).alias("lat"),
        F.transform(axis, lambda i: F.lit(1.0037) + F.lit(0.04) * i).alias("lon"),
        F.transform("embedding", lambda v: v.cast("double")).alias("values"),
    )
