"""Smaller public functions, one short check each."""

import os
import tempfile
import zipfile


from tractlake.plans import books
from tractlake.operators import catalog as cat
from tractlake.operators import feeds, lookup
from tractlake.sources import archives, files
from tests.conftest import rows


def test_read_archives_from_disk(spark):
    d = tempfile.mkdtemp(prefix="tl-zip-")
    with zipfile.ZipFile(os.path.join(d, "a.zip"), "w") as z:
        z.writestr("x.txt", "l1\nl2\n")
    got = archives.read_archives(spark, d, keep_dirs=False)
    assert [(r.member, bytes(r.content)) for r in got.collect()] == [("x.txt", b"l1\nl2\n")]


def test_scan_table_and_layout_schema(spark):
    d = tempfile.mkdtemp(prefix="tl-scan-") + "/t"
    spark.range(3).write.parquet(d)
    assert files.scan_table(spark, d).count() == 3
    s = feeds.layout_schema(feeds.CITY_RATINGS)
    assert s.fieldNames()[:3] == ["id", "name", "state"]


def test_sequence_measures(spark):
    lk = spark.createDataFrame([("B1", 1, 2), ("B2", 1, 1), ("B3", 2, 1)],
                               "varid string, seq int, ordinal int")
    assert rows(cat.sequence_measures(lk, ["B1", "B2", "B3"], 1)) == [("B1", 2), ("B2", 1)]


def test_build_lookup(spark):
    a = spark.createDataFrame([("B1", 1, "x", 1)], "varid string, seq int, label string, ordinal int")
    b = spark.createDataFrame([("B9", 9, "y", 1)], "varid string, seq int, label string, ordinal int")
    assert lookup.build_lookup([a, b]).count() == 2


def test_read_workbook_sheets(spark):
    from tractlake.sources import workbooks
    body = books.workbook_bytes([("a", ["X", "Y"], [["1", "2"]]), ("b", ["Y"], [["3"]])])
    df = spark.createDataFrame([("w.xlsx", body)], "path string, content binary")
    out = workbooks.read_workbook_sheets(df)
    assert rows(out, "X", "Y", "sheet") == [("1", "2", "a"), (None, "3", "b")]


def test_take_columns_and_fill_na_text(spark):
    from tractlake.operators import geo
    df = spark.createDataFrame([("AL", "1", "04000US01", "Aland", "x", 2017)],
                               "a string, b string, c string, d string, e string, year int")
    t = geo.take_columns(df, ["stusab", "logrecno", "geoid", "place_name"], keep=["year"])
    assert t.columns == ["stusab", "logrecno", "geoid", "place_name", "year"]
    f = geo.fill_na_text(spark.createDataFrame([(None, "x")], "state string, county string"),
                         ["state", "county"])
    assert tuple(f.first()) == ("NA", "x")
