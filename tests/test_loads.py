"""End-to-end load jobs on small fixture files."""

import datetime as dt
import io
import os
import tempfile
import zipfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tractlake.plans import books
from tractlake.operators import feeds, ledger
from tractlake.plans import loads
from tractlake.sources import workbooks


def _put(path, body: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body)


@pytest.fixture(scope="module")
def root():
    return tempfile.mkdtemp(prefix="tl-loads-")


GEO_HEAD = ["STATE", "LOGRECNO", "GEOID", "Name"]


def test_load_geo_and_lookup(spark, root):
    for y in (2016, 2017):
        _put(f"{root}/geo/{y}/mini_geo.xlsx", books.workbook_bytes([
            ("al", GEO_HEAD, [["AL", 1, "04000US01", "Aland"],
                              ["AL", 2, "14000US01001020100", "Census Tract 201, B County, Aland"]]),
            ("us", GEO_HEAD + ["extra"], [["US", 3, "31000US10180", "C Metro Area", "x"]])]))
    areas = loads.load_geo(spark, f"{root}/geo", out=f"{root}/out/geo")
    got = {(r.year, r.geoid): r for r in areas.collect()}
    assert len(got) == 6
    assert got[(2017, "14000US01001020100")].logrecno == "0000002"
    assert got[(2016, "31000US10180")].cbsa == "C Metro Area"

    head = ["FILEID", "FILETYPE", "STUSAB", "CHARITER", "SEQUENCE", "LOGRECNO"]
    _put(f"{root}/tmpl/2017/Seq1.xlsx", books.workbook_bytes([
        ("s", head + ["B01_001", "B01_002"], [["", "", "", "", "", "", "Total", "Men"]])]))
    _put(f"{root}/tmpl/2017/seq2.xlsx", books.workbook_bytes([
        ("s", head + ["B02_001"], [["", "", "", "", "", "", "Homes"]])]))
    _put(f"{root}/tmpl/2017/notes.xlsx", books.workbook_bytes([("s", ["a"], [["b"]])]))
    lk = loads.load_lookup(spark, f"{root}/tmpl", out=f"{root}/out/lookup")
    assert sorted((r.year, r.varid, r.seq, r.ordinal) for r in lk.collect()) == [
        (2017, "B01_001", 1, 1), (2017, "B01_002", 1, 2), (2017, "B02_001", 2, 1)]


def _seq_line(code, rec, *vals):
    return ",".join(["SUMFILE", "2017e5", code, "000", "0001", rec, *vals])


def test_load_sequences_and_fact(spark, root):
    base = f"{root}/seq"
    levels = ["All_Geographies_Not_Tracts_Block_Groups", "Tracts_Block_Groups_Only"]
    for region, code in (("Aland", "al"), ("UnitedStates", "us")):
        for lv in levels:
            d = f"{base}/{region}/{lv}"
            _put(f"{d}/g20175{code}.txt", b"geo")
            if code == "us" and lv == levels[1]:
                continue
            rec = "0000002" if lv == levels[1] else ("0000001" if code == "al" else "0000003")
            _put(f"{d}/e20175{code}0001000.txt", (_seq_line(code, rec, "10", "4") + "\n").encode())
            _put(f"{d}/m20175{code}0001000.txt", (_seq_line(code, rec, "1", ".") + "\n").encode())
    lk_rows = [dict(varid="B01_001", seq=1, ordinal=1), dict(varid="B01_002", seq=1, ordinal=2)]
    report = loads.load_sequences(spark, base, 2017, lk_rows, f"{root}/out/seq", seqs=[1, 5])
    assert ("loaded", 1) in report and ("skipped", 5) in report
    e = spark.read.parquet(f"{root}/out/seq/kind=e/year=2017/seq=1")
    assert sorted((r.stusab, r.logrecno, r.B01_001) for r in e.collect()) == [
        ("al", "0000001", D("10.00")), ("al", "0000002", D("10.00")), ("us", "0000003", D("10.00"))]
    m = spark.read.parquet(f"{root}/out/seq/kind=m/year=2017/seq=1")
    assert all(r.B01_002 is None for r in m.collect())

    areas = spark.read.parquet(f"{root}/out/geo")
    seqs = loads.read_loaded_sequences(spark, f"{root}/out/seq", 2017, [1])
    lookup_df = spark.createDataFrame([(r["varid"], r["seq"], r["ordinal"]) for r in lk_rows],
                                      "varid string, seq int, ordinal int")
    catalog_df = spark.createDataFrame(
        [("people", "total", "B01_001", "count", 2017, 9999),
         ("people", "share_men", "B01_002 / total", "rate", 2017, 9999)],
        "group_name string, metric_name string, formula string, statistic string, "
        "start_year int, end_year int")
    fact = loads.build_fact_table(spark, areas, seqs, lookup_df, catalog_df, 2017,
                                  out=f"{root}/out/fact")
    got = {(r.year, r.geoid): (r.total, r.share_men) for r in fact.collect()}
    assert got[(2017, "04000US01")] == (D("10.00"), D("0.400000"))
    assert got[(2017, "14000US01001020100")] == (D("10.00"), D("0.400000"))
    assert got[(2016, "04000US01")] == (None, None)   # outside the window
    assert got[(2017, "31000US10180")] == (D("10.00"), D("0.400000"))  # 'US' vs 'us'


def _ratings_zip(lines):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("ratings_al.txt", "id\tuid\trating\turl\n" + "\n".join(lines) + "\n")
    return buf.getvalue()


def test_feed_batch_runs_once(spark, root):
    notices = spark.createDataFrame([
        ("feeds", "Feed Update 1", dt.datetime(2024, 1, 5, 8)),
        ("feeds", "hello", dt.datetime(2024, 1, 6, 8))],
        "sender string, subject string, email_ts timestamp_ntz")
    _put(f"{root}/feeds/landing/20240105/ratings.zip",
         _ratings_zip(["1\tU1\t \t7\thttps://r/1", "2\t \t \t9\thttps://r/2"]))
    kw = dict(feeds_by_table={"ratings": ("*.zip", feeds.RATINGS)}, sender="feeds",
              run_ts="2024-02-01 00:00:00")
    r1 = loads.run_feed_batch(spark, notices, f"{root}/ledger", f"{root}/feeds", f"{root}/out/feeds", **kw)
    assert r1 == {"batch": "landing/20240105", "tables": ["ratings"]}
    t = spark.read.parquet(f"{root}/out/feeds/ratings")
    assert sorted((r.testratingid, r.universalid, r.rating) for r in t.collect()) == [
        ("1", "U1", D("7")), ("2", " ", D("9"))]
    cur = ledger.read_current(spark, f"{root}/ledger")
    # rows up to the batch date are closed; the later non-feed notice stays open
    assert {r.email_subject: r.updated for r in cur.collect()} == {"Feed Update 1": True,
                                                                    "hello": False}
    r2 = loads.run_feed_batch(spark, notices, f"{root}/ledger", f"{root}/feeds", f"{root}/out/feeds", **kw)
    assert r2["batch"] is None
    assert ledger.read_current(spark, f"{root}/ledger").count() == 2


def test_load_two_sequences_concurrently(spark):
    base = tempfile.mkdtemp(prefix="tl-seq2-")
    lv = "All_Geographies_Not_Tracts_Block_Groups"
    _put(f"{base}/Aland/{lv}/g20185al.txt", b"geo")
    for seq, vals in ((1, ["1"]), (2, ["2", "3"])):
        line = ",".join(["SUMFILE", "2018e5", "al", "000", f"{seq:04d}", "0000001", *vals])
        for kind in ("e", "m"):
            _put(f"{base}/Aland/{lv}/{kind}20185al{seq:04d}000.txt", (line + "\n").encode())
    lk = [dict(varid="B1_001", seq=1, ordinal=1),
          dict(varid="B2_002", seq=2, ordinal=2), dict(varid="B2_001", seq=2, ordinal=1)]
    out = tempfile.mkdtemp(prefix="tl-seq2-out-")
    report = loads.load_sequences(spark, base, 2018, lk, out, parallel=2)
    assert sorted(report) == [("loaded", 1), ("loaded", 2)]
    s2 = spark.read.parquet(f"{out}/kind=e/year=2018/seq=2")
    assert s2.columns[-2:] == ["B2_001", "B2_002"]  # lookup order, not listing order
    assert tuple(s2.select("B2_001", "B2_002").first()) == (D("2.00"), D("3.00"))
