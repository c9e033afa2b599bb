from pyspark.sql import functions as F

from tractlake.operators import geo

SHEET = [  # STATE, LOGRECNO, GEOID, Name, extra
    ("AL", "1", "04000US01", "Aland", "x"),
    ("AL", "1234567", "05000US01001", "B County, Aland", "x"),
    ("AL", "12345678", "14000US01001020100", "Census Tract 201, B County, Aland", "x"),
    ("AL", "22", "15000US010010201001", "Block Group 1, Census Tract 201, B County, Aland", "x"),
    ("US", "5", "31000US10180", "C Metro Area", "x"),
    ("US", "6", "86000US35004", "ZCTA5 35004", "x"),
    ("US", "7", "01000US", "Whole country", "x"),
    ("AL", "8", "14000US01001020200", "Census Tract 202, Aland", "x"),
]


def _geo(spark, **kw):
    raw = spark.createDataFrame(SHEET, "STATE string, LOGRECNO string, GEOID string, Name string, "
                                       "EXTRA string").withColumn("year", F.lit(2017))
    return geo.build_geo(raw, **kw)


def test_record_no_padded_not_cut(spark):
    got = {r.geoid: r.logrecno for r in _geo(spark).collect()}
    assert got["04000US01"] == "0000001"
    assert got["05000US01001"] == "1234567"
    assert got["14000US01001020100"] == "12345678"


def test_place_parts_by_level(spark):
    g = {r.geoid: r for r in _geo(spark).collect()}
    bg = g["15000US010010201001"]
    assert (bg.state, bg.county, bg.census_tract, bg.block_group) == (
        " Aland", " B County", " Census Tract 201", "Block Group 1")
    st = g["04000US01"]
    assert st.state == "Aland" and st.county is None
    assert g["31000US10180"].cbsa == "C Metro Area"
    assert g["86000US35004"].zcta == "35004"
    short = g["14000US01001020200"]
    assert (short.state, short.county, short.census_tract) == (" Aland", "Census Tract 202", "NA")
    assert g["01000US"].state is None


def test_trim_option(spark):
    g = {r.geoid: r for r in _geo(spark, trim=True).collect()}
    assert g["15000US010010201001"].county == "B County"


def test_level_filter_off_by_default(spark):
    assert _geo(spark).count() == len(SHEET)
    kept = {r.geoid for r in _geo(spark, level_filter=True).collect()}
    assert "01000US" not in kept and "04000US01" in kept


def test_spine_codes_labels_and_na(spark):
    s = {r.geoid: r for r in geo.build_spine(_geo(spark)).collect()}
    assert s["04000US01"].geo_level == "State" and s["04000US01"].state_fips == "01"
    c = s["05000US01001"]
    assert (c.geo_level, c.state_fips, c.county_fips) == ("County", "01", "01001")
    t = s["14000US01001020100"]
    assert (t.geo_level, t.census_tract_fips) == ("Census Tract", "01001020100")
    b = s["15000US010010201001"]
    assert (b.geo_level, b.block_group_fips) == ("Block Group", "010010201001")
    assert s["31000US10180"].cbsa_code == "10180" and s["31000US10180"].geo_level == "CBSA"
    assert s["86000US35004"].geo_level == "ZCTA"
    w = s["01000US"]
    assert (w.geo_level, w.state, w.zcta, w.state_fips, w.cbsa_code) == ("NA",) * 5
    assert len(geo.build_spine(_geo(spark)).columns) == 16


def test_spine_years_only_existing(spark):
    a = _geo(spark)
    b = a.withColumn("year", F.lit(2019))
    spine = geo.build_spine(a.unionByName(b))
    years = sorted({r.year for r in spine.select("year").distinct().collect()})
    assert years == [2017, 2019]  # 2018 missing, no placeholder year
    assert spine.filter(F.col("year") == 9999).count() == 0
    assert geo.build_spine(a.unionByName(b), 2018, 2020).select("year").distinct().count() == 1
