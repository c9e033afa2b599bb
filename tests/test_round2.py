"""Inputs that drift: wide rows, two-sheet templates, lost ledger writes, nested divisors, moving measures."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tractlake.plans import books
from tractlake.operators import catalog as cat
from tractlake.operators import facts, ledger, lookup
from tractlake.sources import workbooks


def _books(spark, books):
    return spark.createDataFrame(books, "path string, content binary")


def test_rows_wider_than_the_header_keep_their_cells(spark):
    body = books.workbook_bytes([("s", ["A", "B"], [[1, 2, 3], [4], [9007199254740993, "x", "y", "z"]])])
    got = workbooks.read_workbook_sheets(_books(spark, [("a.xlsx", bytearray(body))]))
    assert got.columns == ["A", "B", "Unnamed: 2", "Unnamed: 3", "path", "sheet"]
    rows = [tuple(r)[:4] for r in got.collect()]
    assert rows == [("1", "2", "3", None), ("4", None, None, None), ("9007199254740993", "x", "y", "z")]


def test_templates_take_the_first_sheet_only(spark):
    fixed = ["F1", "F2", "F3", "F4", "F5", "F6"]
    body = books.workbook_bytes([("E", fixed + ["B1_001"], [["x"] * 6 + ["estimate"]]),
                                     ("M", fixed + ["B1_001", "B9_009"], [["x"] * 6 + ["margin", "other"]])])
    rows = workbooks.read_workbook_rows(_books(spark, [("t/Seq7.xls", bytearray(body))]))
    got = workbooks.read_templates(rows, r"Seq(\d*)\.xls").collect()
    assert [(r.varid, r.seq, r.label, r.ordinal) for r in got] == [("B1_001", 7, "estimate", 1)]


def test_ledger_ignores_lost_writes_and_raises_on_unreadable(spark, tmp_path):
    root = str(tmp_path / "ledger")
    assert ledger.current_version(spark, root) is None and ledger.read_current(spark, root) is None
    ledger.write_snapshot(spark.range(3), root, 1)
    (tmp_path / "ledger" / "v=000000000002").mkdir()  # a write that never committed
    assert ledger.current_version(spark, root) == 1 and ledger.read_current(spark, root).count() == 3
    ledger.write_snapshot(spark.range(0), root, 2)  # a version without rows counts
    assert ledger.current_version(spark, root) == 2
    for f in (tmp_path / "ledger" / "v=000000000002").glob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|schema|footer"):
        ledger.read_current(spark, root).count()


@pytest.mark.parametrize("formula, guarded", [
    ("a / ((b + c) - d)", "a / NULLIF(((b + c) - d), 0)"),
    ("a / (b * (c - d)) / e", "a / NULLIF((b * (c - d)), 0) / NULLIF(e, 0)"),
    ("a / coalesce(b, 0)", "a / NULLIF(coalesce(b, 0), 0)"),
    ("a / ((b / c) - d)", "a / NULLIF(((b / NULLIF(c, 0)) - d), 0)"),
    ("a / NULLIF(b, 0)", "a / NULLIF(b, 0)"),
    ("a/b", "a/ NULLIF(b, 0)".replace("a/", "a/")),
])
def test_nested_divisors_are_guarded_alike(spark, formula, guarded):
    squeeze = lambda x: x.replace(" ", "")
    assert squeeze(cat.guard_text(formula)) == squeeze(guarded)
    df = spark.createDataFrame([(formula,)], "f string")
    assert df.select(cat.guard_division("f")).first()[0] == cat.guard_text(formula)


def test_names_defined_earlier_win_over_measure_shapes():
    rows = [dict(group_name="g", metric_name="Count_all", formula="B1_001", statistic="count", start_year=1, end_year=2),
            dict(group_name="g", metric_name="r", formula="B1_002 / Count_all", statistic="rate", start_year=1, end_year=2)]
    plan, = cat.plan_groups(rows, 2020)
    assert plan.measures == ["B1_001", "B1_002"] and "Count_all" not in plan.metrics[1][1]


def test_a_measure_is_read_from_the_sequence_of_its_year(spark):
    schema = "stusab string, logrecno string, year int, B1_001 decimal(16,2)"
    seqs = {1: spark.createDataFrame([("al", "1", 2009, D(10)), ("al", "1", 2010, D(99))], schema),
            2: spark.createDataFrame([("al", "1", 2009, D(98)), ("al", "1", 2010, D(20))], schema)}
    rows = [dict(varid="B1_001", seq=1, ordinal=1, year=2009), dict(varid="B1_001", seq=2, ordinal=3, year=2010)]
    areas = spark.createDataFrame([(y, "al", "1") for y in (2009, 2010, 2011)], "year int, stusab_key string, logrecno string")
    got = facts.areas_with_measures(areas, seqs, rows, ["B1_001"]).orderBy("year").collect()
    assert [r.B1_001 for r in got] == [D(10), D(20), None]
    assert lookup.sequence_wide(rows, 2, 2009) is None and len(lookup.sequence_wide(rows, 2, 2010).fields) == 7
    df = spark.createDataFrame(rows, "varid string, seq int, ordinal int, year int")
    assert [r.seq for r in cat.group_sequences(df, ["B1_001"], 2010).collect()] == [2]
    assert cat.sequence_measures(df, ["B1_001"], 1, 2009).filter(F.col("ordinal") == 1).count() == 1


def _members(spark, *texts):
    return spark.createDataFrame([(f"m{i}.txt", bytearray(t.encode())) for i, t in enumerate(texts)],
                                 "path string, content binary")


def test_feed_members_are_read_by_their_own_header(spark):
    from tractlake.operators import feeds
    got = feeds.read_feed_archives(_members(
        spark, "id\tyear\tdescription\n1\t1999\tplain\n", "description\tid\tyear\n\"say \"\"hi\"\"\tthere\nyou\"\t2\t2002\n",
        "year\tid\n2003\t3\n\n2004\t4\n", "id\tyear\tdescription\n5\t \t2005\td\n6\t \t2006\te\n", "", "id\n"),
        feeds.DICTIONARY)
    rows = sorted((r.id, int(r.year), r.description) for r in got.collect())
    assert rows == [("1", 1999, "plain"), ("2", 2002, 'say "hi"\tthere\nyou'), ("3", 2003, None), ("4", 2004, None),
                    ("5", 2005, "d"), ("6", 2006, "e")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Exchange" not in plan


def test_feed_members_with_unknown_columns_or_still_too_wide_fail(spark):
    from tractlake.operators import feeds
    with pytest.raises(Exception, match="unknown or repeated names: nonsense"):
        feeds.read_feed_archives(_members(spark, "id\tnonsense\n1\t2\n"), feeds.DICTIONARY).collect()
    with pytest.raises(Exception, match="more fields than the header"):
        feeds.read_feed_archives(_members(spark, "id\tyear\n1\t2\t3\n"), feeds.DICTIONARY).collect()
