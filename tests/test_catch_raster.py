"""Catch and raster operators on micro-fixtures (D2, D3, D4, D5, D6, D13, D16, D26) and invariants."""
import pytest
from pyspark.sql import functions as F

from movegrid.operators import catch, raster
from movegrid.params import ELASMOBRANCH_KEYWORDS

SPECIES = "species_code string, name_en string, name_fr string, name_es string, scientific_name string, group_en string"
FACTS = "species_code string, area_code int, period int, value double, row_order long"
AREAS = "code int, area_name string, ocean_group string, inland_marine_group string"


@pytest.fixture()
def species(spark):
    return spark.createDataFrame([
        ("BSH", "Blue shark", "Peau bleue", "Tiburón azul", "Prionace glauca", "Sharks, rays, chimaeras"),
        ("CRF", "Crayfish", None, None, "Astacidae", "Freshwater crustaceans"),
        ("RUS", None, None, None, "АКУЛА полярная", None),
        ("COD", "Atlantic cod", "Morue", "Bacalao", "Gadus morhua", "Cods, hakes, haddocks"),
        ("NUL", None, None, None, None, None),
    ], SPECIES)


def test_keyword_match_case_unicode_and_substring_overmatch(spark, species):
    codes = {r.species_code for r in catch.match_species(species).collect()}
    assert codes == {"BSH", "CRF", "RUS"}           # 'ray' inside 'Crayfish' (D4), Cyrillic upper case
    whole = {r.species_code for r in catch.match_species(species, whole_word=True).collect()}
    assert "CRF" not in whole and "BSH" in whole


def test_enrich_inner_species_left_areas_marine_only(spark, species):
    facts = spark.createDataFrame([
        ("BSH", 27, 2000, 10.0, 1), ("BSH", 5, 2000, 3.0, 2), ("BSH", 99, 2001, 4.0, 3),
        ("COD", 27, 2000, 100.0, 4), (None, 27, 2000, 1.0, 5),
    ], FACTS)
    areas = spark.createDataFrame([(27, "NE Atlantic", "Atlantic", "Marine areas"), (5, "Lake", "Inland", "Inland waters"),
                                   (99, "Other", "Pacific", None)], AREAS)
    j = catch.enrich(facts, catch.match_species(species), areas)
    assert sorted(r.row_order for r in j.collect()) == [1, 2]     # inland kept (D3), NULL group dropped, NULL key (D16)
    j2 = catch.enrich(facts, catch.match_species(species), areas, marine_label="Marine areas")
    assert [r.row_order for r in j2.collect()] == [1]


def test_area_filter_compares_integers(spark):
    df = spark.createDataFrame([("A", 27, 2000, 1.0, 1), ("A", 28, 2000, 2.0, 2)], FACTS)
    assert catch.in_area(df, "27").count() == 1                  # string target means the integer area (D2)


def test_area_period_first_non_missing_name_in_source_order(spark):
    df = spark.createDataFrame([
        ("A", 27, 2000, 1.0, 3, "late", "s3"), ("B", 27, 2000, 2.0, 1, None, "s1"), ("C", 27, 2000, 4.0, 2, "early", None),
    ], FACTS + ", name_en string, scientific_name string")
    r = catch.area_period(df).first()
    assert (r.value, r.name_en, r.scientific_name) == (7.0, "early", "s1")   # D6


def test_empty_summary_is_zero(spark):
    df = spark.createDataFrame([], FACTS)
    r = catch.summary(df).first()
    assert (r.unique_species, r.unique_areas, r.total_catch) == (0, 0, 0.0)


def test_top_species_ties_by_code(spark):
    df = spark.createDataFrame([("B", 27, 2000, 5.0, 1, "b"), ("A", 27, 2000, 5.0, 2, "a"), ("C", 27, 2000, 9.0, 3, "c"),
                                ("D", 21, 2000, 99.0, 4, "d")], FACTS + ", name_en string")
    assert [r.species_code for r in catch.top_species(df, 27, 2).collect()] == ["C", "A"]


def totals(spark, rows):
    return spark.createDataFrame(rows, "area_code int, period int, value double")


def test_axis_lengths_exact(spark):
    assert (raster.axis_length(180, 1.0), raster.axis_length(360, 1.0)) == (181, 361)
    assert (raster.axis_length(180, 0.1), raster.axis_length(360, 0.1)) == (1801, 3601)   # D26: exact, not drifting


def test_area27_cells_and_conservation(spark):
    b = raster.area_bounds(spark)
    t = totals(spark, [(27, 2000, 1891.0), (27, 2001, 3782.0)])
    cells = raster.cells(t, b, 1.0)
    per = cells.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("catch").alias("s")).collect()
    assert {r.period: r.n for r in per} == {2000: 31 * 61, 2001: 31 * 61}
    assert {r.period: round(r.s, 6) for r in per} == {2000: 1891.0, 2001: 3782.0}
    g = raster.grid(t, b, 1.0)
    st = raster.stats(g, 1.0).first()
    assert (st.n_lat, st.n_lon, st.nonzero_cells) == (181, 361, 1891)
    assert st.total_distributed == pytest.approx(5673.0)
    one = g.where((F.col("lat") == 40.0) & (F.col("lon") == -20.0)).first()
    assert one.catch == pytest.approx(3.0)


def test_antimeridian_wrap_and_parity(spark):
    b = raster.area_bounds(spark)
    t = totals(spark, [(88, 2000, 100.0)])
    wrapped = raster.cells(t, b, 1.0)
    lons = {r.lon for r in wrapped.select("lon").distinct().collect()}
    assert min(lons) == -180.0 and max(lons) == 180.0 and 0.0 not in lons and 120.0 in lons and -120.0 in lons
    assert wrapped.agg(F.sum("catch")).first()[0] == pytest.approx(100.0)
    assert raster.cells(t, b, 1.0, wrap_antimeridian=False).count() == 0      # reference behaviour (D13)
    un = raster.unallocated(t, b, 1.0, wrap_antimeridian=False).collect()
    assert [(r.area_code, r.value) for r in un] == [(88, 100.0)]


def test_unknown_area_is_unallocated(spark):
    b = raster.area_bounds(spark)
    t = totals(spark, [(2, 2000, 5.0), (27, 2000, 1.0)])
    assert raster.cells(t, b, 5.0).where(F.col("area_code") == 2).count() == 0
    assert [r.area_code for r in raster.unallocated(t, b, 5.0).collect()] == [2]


def test_wide_is_dense_with_labels(spark):
    b = raster.area_bounds(spark)
    w = raster.wide(raster.grid(totals(spark, [(27, 2000, 1.0)]), b, 5.0), 5.0)
    assert w.count() == 37 and len(w.columns) == 1 + 73
    assert w.columns[1] == "lon_-180.0" and w.columns[-1] == "lon_180.0"
    assert {r.lat for r in w.select("lat").collect()} >= {"lat_-90.0", "lat_90.0"}


def test_keyword_list_is_complete():
    assert len(ELASMOBRANCH_KEYWORDS) == 23
