from tractlake.operators import listing
from tests.conftest import rows


def test_document_rules_and_near_misses(spark):
    paths = [("docs/5_year/Sequence_Number_and_Table_Number_Lookup.xls",),
             ("docs/1_year/Sequence_Number_and_Table_Number_Lookup.xls",),   # near miss
             ("docs/user_tools/ACS_5yr_Seq_Table_Number_Lookup.xls",),
             ("docs/5_year/ACS2016_5-Year_TableShells.xlsx",),
             ("docs/shells/ACS2016_Table_Shells.xlsx",),
             ("docs/1_year/ACS2016_Table_Shells.xlsx",),                     # near miss
             ("docs/tech/ACS_2016_SF_5YR_Appendices.xls",),
             ("docs/geography/5_year_Mini_Geo.xlsx",),
             ("docs/geography/1_year_Mini_Geo.xlsx",)]                       # near miss
    df = spark.createDataFrame(paths, "path string")
    out = listing.classify_files(df, listing.document_rules(2016))
    assert sorted(r.target for r in out.collect()) == [
        "2016_appendices.xls", "2016_mini_geo.xlsx", "2016_seq_table_lookup.xls",
        "2016_seq_table_lookup.xls", "2016_table_shells.xlsx", "2016_table_shells.xlsx"]


def test_template_matching_and_sequence_numbers(spark):
    df = spark.createDataFrame([("x/2016_5yr_Summary_FileTemplates.zip",),
                                ("x/2016_5yr_SummaryFileTemplates.zip",), ("x/other.zip",)], "path string")
    assert listing.match_files(df).count() == 2
    t = spark.createDataFrame([("a/templates/Seq1.xls",), ("a/templates/seq12.xls",),
                               ("a/templates/notes.xls",), ("a/templates/Seq.xls",)], "path string")
    assert sorted(r.seq for r in listing.extract_sequence_no(t).collect()) == [1, 12]


def test_region_codes_and_sequence_paths(spark):
    lst = spark.createDataFrame([
        ("s/Alabama/All_Geographies_Not_Tracts_Block_Groups/g20175al.txt",),
        ("s/Alabama/All_Geographies_Not_Tracts_Block_Groups/e20175al0001000.txt",),
        ("s/Alabama/Tracts_Block_Groups_Only/g20175al.txt",),
        ("s/UnitedStates/All_Geographies_Not_Tracts_Block_Groups/g20175us.txt",),
        ("s/UnitedStates/Tracts_Block_Groups_Only/g20175us.txt",)], "path string")
    codes = listing.region_code_from_listing(lst, 2017)
    assert {r.region_code for r in codes.collect()} == {"al", "us"}
    from pyspark.sql import functions as F
    folders = codes.select(F.regexp_extract("folder", r"^(.*/)", 1).alias("root"),
                           F.regexp_extract("folder", r"([^/]*)$", 1).alias("level"), "region_code")
    paths = sorted(r.path for r in listing.sequence_paths(folders, 2017, 3).collect())
    assert len(paths) == 6  # (2 + 2 + 1 folders... no tract level for us) x (e, m)
    assert "s/Alabama/Tracts_Block_Groups_Only/m20175al0003000.txt" in paths
    assert not any("UnitedStates/Tracts" in p for p in paths)


def test_new_files_rerun_is_noop(spark):
    lst = spark.createDataFrame([("k1",), ("k2",)], "key string")
    landed = spark.createDataFrame([("k1",)], "key string")
    new = listing.new_files_only(lst, landed)
    assert rows(new) == [("k2",)]
    assert listing.new_files_only(lst, landed.unionByName(new)).count() == 0
