"""The long sequence table: reading, checks, folders that are absent, and the wide form."""

import os
import subprocess
import sys
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tractlake.operators import sequences as sq
from tractlake.plans import loads

LEVELS = ["All_Geographies_Not_Tracts_Block_Groups", "Tracts_Block_Groups_Only"]
LOOKUP = [(2016, "B1_001", 1, 1), (2016, "B1_002", 1, 2), (2017, "B1_002", 1, 1), (2017, "B1_003", 1, 2),
          (2017, "B1_003", 1, 9), (2017, "B2_001", 2, 1)]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def line(code, rec, *cells):
    return ",".join(["SUMFILE", "e5", code, "000", "0001", rec, *cells]) + "\n"


def tree(base):
    for year in (2016, 2017):
        for region, code in (("Aland", "al"), ("UnitedStates", "us")):
            for i, level in enumerate(LEVELS):
                at = f"{base}/{year}/{region}/{level}"
                put(f"{at}/g{year}5{code}.csv", "geo")
                for kind in "em":
                    put(f"{at}/{kind}{year}5{code}0001000.txt", line(code, f"000000{i}", f"{year}", ".") + "\n")
    put(f"{base}/2017/Aland/{LEVELS[0]}/e20175al0002000.txt", line("al", "0000000", "7.125"))
    put(f"{base}/2017/Aland/{LEVELS[0]}/e20175al0009000.txt", line("al", "0000000", "1"))
    put(f"{base}/2017/Aland/{LEVELS[0]}/e20175zz0001000.txt", line("zz", "0000000", "1", "1"))  # another region's code
    put(f"{base}/2017/Aland/{LEVELS[0]}/readme.txt", "no sequence file")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("seq"))
    tree(base)
    lookup = spark.createDataFrame(LOOKUP, "year int, varid string, seq int, ordinal int")
    out = f"{base}-out"
    skipped = loads.load_sequence_store(spark, base, [2016, 2017], lookup, out)
    assert [tuple(r) for r in skipped.collect()] == [("e", 2017, 9)] or [r.seq for r in skipped.collect()] == [9]
    return out


def test_store_rows(spark, store):
    got = sorted((r.kind, r.year, r.seq, r.stusab, r.logrecno, r.varid, r.value)
                 for r in sq.read_store(spark, store, None).filter("kind = 'e'").collect())
    # the national tract folder does not count; '.' is no value; 2017 has other columns
    want = [("e", y, 1, c, rec, v, x) for y, ms in ((2016, ("B1_001", "B1_002")), (2017, ("B1_002", "B1_003")))
            for c, rec in (("al", "0000000"), ("al", "0000001"), ("us", "0000000"))
            for v, x in zip(ms, (D(y), None))]
    assert got == sorted(want + [("e", 2017, 2, "al", "0000000", "B2_001", D("7.13"))], key=lambda r: r[:6])


def test_wide_frames_over_years_and_absent_folders(spark, store):
    rows = [dict(varid=v, seq=s) for _, v, s, _ in LOOKUP] + [dict(varid="B5_001", seq=5)]
    frames = sq.stored_sequences(spark, store, rows)
    one = {(r.year, r.stusab, r.logrecno): (r.B1_001, r.B1_002, r.B1_003) for r in frames[1].collect()}
    assert one[(2016, "al", "0000001")] == (D(2016), None, None) and one[(2017, "us", "0000000")] == (None, D(2017), None)
    assert [r.year for r in frames[2].collect()] == [2017] and frames[5].collect() == []
    plan = frames[2]._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "(seq" in plan.split("PartitionFilters: [")[1].split("]")[0]
    only = sq.stored_sequences(spark, store, rows, years=[2016])
    assert {r.year for r in only[1].collect()} == {2016} and only[2].collect() == []


def test_a_second_load_replaces_only_its_years(spark, store, tmp_path):
    lookup = spark.createDataFrame(LOOKUP, "year int, varid string, seq int, ordinal int")
    tree(str(tmp_path))
    put(f"{tmp_path}/2017/Aland/{LEVELS[0]}/e20175al0002000.txt", line("al", "0000000", "8"))
    out = f"{tmp_path}-out"
    for years in ([2016], [2017], [2017]):
        loads.load_sequence_store(spark, str(tmp_path), years, lookup, out)
    assert sq.read_store(spark, out, None).count() == sq.read_store(spark, store, None).count()
    assert sq.read_store(spark, out, seqs=[2]).first().value == D(8)


@pytest.mark.parametrize("cells, why", [(["1"], "fields where the lookup has"), (["1", "2", "3"], "fields where the lookup has"),
                                        (["1", "x"], "CAST_INVALID_INPUT"), (["1", "9" * 20], "NUMERIC_VALUE_OUT_OF_RANGE")])
def test_bad_lines_fail(spark, tmp_path, cells, why):
    put(f"{tmp_path}/e20165al0001000.txt", line("al", "0000001", *cells))
    lookup = spark.createDataFrame(LOOKUP, "year int, varid string, seq int, ordinal int")
    with pytest.raises(Exception, match=why):
        sq.write_store(sq.long_form(sq.sequence_lines(spark, str(tmp_path)), lookup), f"{tmp_path}-out")


def test_a_record_twice_fails_and_pairs(spark, tmp_path):
    lookup = spark.createDataFrame([("B1_001", 1, 1)], "varid string, seq int, ordinal int")  # for all years
    put(f"{tmp_path}/e20165al0001000.txt", line("al", "1", "1"))
    put(f"{tmp_path}/m20165al0001000.txt", line("al", "1", "2") + line("al", "2", "3"))
    cells = sq.long_form(sq.sequence_lines(spark, str(tmp_path)), lookup)
    assert sorted((r.logrecno, r.estimate, r.margin) for r in sq.paired(cells).collect()) == [("1", D(1), D(2)), ("2", None, D(3))]
    twice = cells.unionAll(cells)
    for made in (sq.paired(twice), sq.wide_form(twice.filter("kind = 'e'"), ["B1_001"])):
        with pytest.raises(Exception, match="measure twice"):
            made.select(F.count("*")).collect()  # also where no checked column is read


def test_loaded_years_that_lack_a_sequence(spark, tmp_path):
    for year, seq, m in ((2016, 1, "A"), (2017, 1, "B"), (2017, 2, "C")):
        spark.createDataFrame([("al", "1", 1)], f"stusab string, logrecno string, {m} int").write.parquet(
            f"{tmp_path}/kind=e/year={year}/seq={seq}")
    got = loads.read_loaded_sequences(spark, str(tmp_path), [2015, 2016, 2017], [1, 2, 3])
    assert sorted(got) == [1, 2]
    assert sorted((r.year, r.A, r.B) for r in got[1].collect()) == [(2016, 1, None), (2017, None, 1)]
    assert [(r.year, r.C) for r in got[2].collect()] == [(2017, 1)]


def test_entry_without_an_optional_library():
    code = ("import sys; sys.modules['zstandard'] = None; import __spark_entry__ as E; "
            "q = E.queries(); assert 'fact_full' in q and not any(n.startswith('op') and n[2:3].isdigit() for n in q)")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
