import io
import os
import tempfile
import zipfile
from decimal import Decimal as D

import pytest

from tractlake.plans import books
from tractlake.sources import archives, files, workbooks
from tests.conftest import rows


def _zip(entries):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, body in entries:
            z.writestr(name, body)
    return buf.getvalue()


def test_expand_archive_variants(spark):
    df = spark.createDataFrame([
        ("s3/raw/a.zip", _zip([("dir/", b""), ("dir/x.txt", b"x"), ("y.txt", b"yy")])),
        ("s3/raw/empty.zip", _zip([]))], "path string, content binary")
    a = archives.expand_archives(df)
    assert sorted(r.path for r in a.collect()) == ["s3/raw/dir/", "s3/raw/dir/x.txt", "s3/raw/y.txt"]
    b = archives.expand_archives(df, keep_dirs=False, flatten=True)
    assert sorted((r.path, bytes(r.content)) for r in b.collect()) == [
        ("s3/raw/x.txt", b"x"), ("s3/raw/y.txt", b"yy")]


def test_workbook_sheets_stack_by_name(spark):
    body = books.workbook_bytes([("al", ["STATE", "LOGRECNO"], [["AL", 12], ["AL", "0000003"]]),
                                     ("ak", ["STATE", "LOGRECNO", "EXTRA"], [["AK", 7, "e"]])])
    df = spark.createDataFrame([("geo.xlsx", body)], "path string, content binary")
    out = workbooks.stack_sheets(workbooks.read_workbook_rows(df))
    assert out.columns[:3] == ["STATE", "LOGRECNO", "EXTRA"]
    assert rows(out, "STATE", "LOGRECNO", "EXTRA") == [
        ("AK", "7", "e"), ("AL", "0000003", None), ("AL", "12", None)]


def _write(text):
    d = tempfile.mkdtemp(prefix="tl-src-")
    p = os.path.join(d, "f.csv")
    with open(p, "wb") as f:
        f.write(text.encode("utf-8"))
    return p


SCHEMA = "id long, name string, amount decimal(16,2)"


def test_positional_read_and_failfast(spark):
    from pyspark.sql.types import _parse_datatype_string
    s = _parse_datatype_string(SCHEMA)
    ok = files.read_positional(spark, _write("a,b,c\n1,x,2.5\n2,y,\n"), s)
    assert rows(ok) == [(1, "x", D("2.50")), (2, "y", None)]
    with pytest.raises(Exception):
        files.read_positional(spark, _write("a,b,c\n1,x,abc\n"), s).collect()
    # the bad value sits in a column the query drops: still fails once written
    bad = files.read_positional(spark, _write("a,b,c\n1,x,abc\n"), s)
    with pytest.raises(Exception):
        files.load_table(bad, tempfile.mkdtemp(prefix="tl-out-") + "/t")


def test_sequence_null_marker(spark):
    from pyspark.sql.types import _parse_datatype_string
    s = _parse_datatype_string("fileid string, filetype string, stusab string, chariter string, "
                               "sequence string, logrecno string, B1 decimal(16,2)")
    df = files.read_sequence(spark, _write("SUMFILE,2017e5,al,000,0001,0000001,.\n"), s)
    assert df.collect()[0].B1 is None


def test_catalog_bom_quotes_trim(spark):
    p = _write("﻿group,roofname,formula,statistic,start_year,end_year,notes\n"
               'g,name_a ,B01_001,count,2009,9999,"a, b"\n')
    r = files.read_catalog(spark, p).collect()[0]
    assert (r.group_name, r.metric_name, r.notes, r.end_year) == ("g", "name_a", "a, b", 9999)


def test_read_yearly_irregular(spark):
    base = tempfile.mkdtemp(prefix="tl-yearly-")
    for y in (2010, 2012, 2013):
        sub = f"{base}/first/{y}" if y == 2010 else f"{base}/{y}_gaz"
        spark.createDataFrame([(y * 10,)], "v long").write.parquet(sub)
    df = files.read_yearly(spark, [2010, 2012, 2013],
                           lambda y: f"{base}/first/{y}" if y == 2010 else f"{base}/{y}_gaz")
    assert rows(df, "v", "year") == [(20100, 2010), (20120, 2012), (20130, 2013)]


def test_sequence_short_row_and_bad_number_abort_on_load(spark):
    from pyspark.sql.types import _parse_datatype_string
    s = _parse_datatype_string("fileid string, filetype string, stusab string, chariter string, "
                               "sequence string, logrecno string, B1 decimal(16,2), B2 decimal(16,2)")
    short = files.read_sequence(spark, _write("SUMFILE,2017e5,al,000,0001,0000001,5\n"), s)
    with pytest.raises(Exception):
        files.load_table(short, tempfile.mkdtemp(prefix="tl-out-") + "/t")
    bad = files.read_sequence(spark, _write("SUMFILE,2017e5,al,000,0001,0000001,5,x\n"), s)
    # a query that ignores B2 does not parse it (CSV column pruning) ...
    assert bad.select("logrecno").collect()[0].logrecno == "0000001"
    # ... which is why a load writes every column: there the bad number fails
    with pytest.raises(Exception):
        files.load_table(bad, tempfile.mkdtemp(prefix="tl-out-") + "/t")
