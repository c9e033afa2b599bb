"""Findings of round 3: inputs stored once, lines dealt instead of cells, archives and workbooks piece by piece."""

import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tractlake.operators import facts
from tractlake.operators import sequences as sq
from tractlake.plans import books, factstore, loads, stored
from tractlake.sources import archives, workbooks


def plan(df):
    return df._jdf.queryExecution().toString()


def test_ranks_are_counted_without_object_aggregates(spark):
    n = "CAST(NULL AS decimal(16,2))"
    fact = spark.sql(f"SELECT 2016 AS year, 'x' AS geoid, {n} AS a")
    two = spark.sql(f"SELECT 2016 AS year, 'x' AS geoid, 0 AS rank, CAST(1 AS decimal(16,2)) AS a UNION ALL SELECT 2016, 'x', 1, {n}")
    df = facts.upsert_ranked(fact, two)
    assert "ObjectHashAggregate" not in plan(df) and [r.a for r in df.collect()] == [1]
    with pytest.raises(Exception, match="duplicate key"):
        facts.upsert_ranked(fact, two.union(two.limit(1))).collect()


def test_known_years_are_not_looked_up(spark, tmp_path, monkeypatch):
    root, cols = str(tmp_path / "fact"), "year int, geoid string, a decimal(16,2)"
    factstore.create(spark, root, spark.createDataFrame([(2016, "x", None), (2017, "x", None)], cols))
    monkeypatch.setattr(factstore, "years_of", lambda df: pytest.fail("computed to find its years"))
    src = spark.sql("SELECT 2016 AS year, 'x' AS geoid, CAST(1 AS decimal(16,2)) AS a")
    assert factstore.upsert(spark, root, src, years={2016, 2030}) == {"version": 2, "years": [2016]}
    more = src.selectExpr("2018 AS year", "geoid", "a")
    assert factstore.add_years(spark, root, more, years={2016, 2018}) == {"version": 3, "years": [2018]}
    assert {r.year: r.a for r in factstore.read(spark, root).collect()} == {2016: 1, 2017: None, 2018: 1}


def test_catalog_runs_read_stored_inputs(spark, monkeypatch):
    seen, run = [], loads.update_fact_store

    def spy(spark, root, areas, seqs, *rest):
        seen.extend([areas, *seqs.values()])
        return run(spark, root, areas, seqs, *rest)
    monkeypatch.setattr(loads, "update_fact_store", spy)
    E.queries()["fact_store_groups"](spark, SF_SMALL)
    assert len(seen) == 8 and all("/inputs-" in f for df in seen for f in df.inputFiles())


def test_workbook_rows_take_arrow_batches(spark):
    body = books.workbook_bytes([("S", ["a", "b"], [["x", 1], [None, 2]])])
    (out,) = workbooks._rows([pa.RecordBatch.from_pydict({"path": ["p"], "content": [body]})])
    assert out.to_pylist() == [
        {"path": "p", "sheet": "S", "sheet_no": 0, "row_no": 1, "header": ["a", "b"], "values": ["x", "1"]},
        {"path": "p", "sheet": "S", "sheet_no": 0, "row_no": 2, "header": ["a", "b"], "values": [None, "2"]}]
    df = workbooks.read_workbook_rows(spark.createDataFrame([("p", bytearray(body))], "path string, content binary"))
    assert df.count() == 2 and "MapInArrow" in plan(df)


def test_pack_takes_arrow_batches():
    b = pa.RecordBatch.from_pydict({"n": ["a", "b", "c"], "t": ["x", None, "\u00e9"], "k": [3, 1, 2]})
    got = [x.to_pylist()[0] for x in archives._pack([b], "f", "n", "t", "k", 2)]
    assert [x["path"] for x in got] == ["f/archive-1.zip", "f/archive-2.zip"]
    z = [zipfile.ZipFile(io.BytesIO(x["content"])) for x in got]
    assert z[0].namelist() == ["pages/", "pages/a", "pages/b"] and z[0].read("pages/b") == b"None"
    assert z[1].read("pages/c") == "\u00e9".encode()


def test_lines_are_dealt_and_not_cells(spark, monkeypatch, tmp_path):
    lookup = spark.createDataFrame([(1, "m1", 1), (1, "m2", 2)], "seq int, varid string, ordinal int").filter(F.rand() < 2)
    lines = spark.createDataFrame([("p", "e", 2016, 1, "a,b,c,d,e,7,1,.")], "path string, kind string, year int, seq int, value string")
    cells = sq.long_form(sq.together(lines), lookup)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = cells._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning(kind" in p.split("Generate", 1)[1]
    sq.write_store(cells, str(tmp_path / "s"), dealt=True)
    got = sq.read_store(spark, str(tmp_path / "s")).select("logrecno", "varid", "value").collect()
    assert sorted((r[0], r[1], r[2] is None) for r in got) == [("7", "m1", False), ("7", "m2", True)]


def test_sequence_files_are_landed_in_one_write(spark):
    root = stored._landed(spark, stored._sequence_frames(spark, SF_SMALL))
    files = spark.read.option("recursiveFileLookup", "true").text(root).inputFiles()
    jobs = {f.rsplit("/", 1)[1].rsplit("-c", 1)[0].split("-", 2)[2] for f in files}
    assert len(jobs) == 1 and {f.split("/seq=")[1][0] for f in files} == {"1", "2", "3"}


def test_groups_read_stored_inputs(spark):
    p = plan(E.queries()["fact_full_per_group"](spark, SF_SMALL))
    assert "/inputs-" in p and "lineitem.parquet" not in p


def test_slices_read_stored_inputs(spark):
    p = plan(E.queries()["fact_sliced"](spark, SF_SMALL))
    assert "/inputs-" in p and "lineitem.parquet" not in p


def test_upserts_read_stored_inputs(spark, monkeypatch):
    seen, frame = [], facts.group_frame

    def spy(p, seqs, lookup_rows, geo):
        seen.extend([geo, *seqs.values()])
        return frame(p, seqs, lookup_rows, geo)
    monkeypatch.setattr(facts, "group_frame", spy)
    E.queries()["fact_store_upsert"](spark, SF_SMALL)
    assert len(seen) == 8 and all("/inputs-" in f for df in seen for f in df.inputFiles())
