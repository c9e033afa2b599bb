"""Checks that fail the job run whichever columns are read."""

from decimal import Decimal as D

import pytest

from tractlake.operators import catalog as cat
from tractlake.operators import facts, lookup
from tractlake.sources import archives

SEQ = "year int, stusab string, logrecno string, A decimal(16,2), B decimal(16,2)"
ONE = [(2017, "al", "1", D(1), D(2))]


@pytest.fixture()
def twice(spark):
    return spark.createDataFrame(ONE * 2, SEQ)


@pytest.fixture()
def once(spark):
    return spark.createDataFrame(ONE, SEQ)


def fails(df, *columns):
    with pytest.raises(Exception, match="duplicate key"):
        df.select(*columns).collect()


def test_a_repeated_key_in_measures_long(twice, once):
    for e, m in ((twice, once), (once, twice)):
        fails(lookup.measures_long(e, m, ["A"]), "estimate")
        fails(lookup.measures_long(e, m, ["A"]), "year")
    assert lookup.measures_long(once, once, ["A", "B"]).count() == 2


@pytest.mark.parametrize("strategy", ["union", "full"])
def test_a_repeated_key_in_joined_sequences(twice, once, strategy):
    fails(facts.join_sequences([twice], strategy=strategy), "year")
    other = once.withColumnsRenamed({"A": "C", "B": "E"})
    fails(facts.join_sequences([other, twice], strategy=strategy), "C")
    assert facts.join_sequences([once], strategy=strategy).select("A").first().A == D(1)


def test_a_repeated_key_in_attached_data(spark, twice, once):
    areas = spark.createDataFrame([(2017, "g1", "AL", "1"), (2017, "g2", "AL", "2")],
                                  "year int, geoid string, stusab string, logrecno string")
    fails(facts.attach_area(twice, areas, ["A"]), "A")
    # Without a data column Spark drops the join; the areas are right either way.
    assert facts.attach_area(twice, areas, ["A"]).select("geoid").count() == 2
    assert sorted(tuple(r) for r in facts.attach_area(once, areas, ["B"]).collect()) == [(2017, "g1", D(2)), (2017, "g2", None)]


def test_a_metric_with_two_types(spark):
    c = spark.createDataFrame([("m ", "rate"), ("M", "count")], "metric_name string, statistic string")
    with pytest.raises(Exception, match="two types: m"):
        cat.metric_types(c).select("metric_name").collect()


def test_sequence_measures_of_all_sequences(spark):
    lk = spark.createDataFrame([(1, "A", 1, 2016), (1, "B", 2, 2016), (2, "A", 1, 2017), (2, "C", 2, 2017)],
                               "seq int, varid string, ordinal int, year int")
    wanted = spark.createDataFrame([("A",), ("C",), ("A",), ("Z",)], "varid string")
    assert sorted(tuple(r) for r in cat.sequence_measures(lk, wanted).collect()) == [(1, "A", 1), (2, "A", 1), (2, "C", 2)]
    assert [tuple(r) for r in cat.sequence_measures(lk, ["A", "C"], 2, 2017).orderBy("ordinal").collect()] == [("A", 1), ("C", 2)]


def test_empty_members_have_a_piece(spark):
    p = spark.createDataFrame([(1, "a.txt", ""), (2, "b.txt", "x" * 50), (3, "c.txt", "")], "key int, name string, body string")
    parts = archives.expand_chunks(archives.pack_archives(p, "landing/pages", "name", "body", "key"), chunk_bytes=20, keep_empty=True)
    assert sorted((r.member, r.offset, len(r.content)) for r in parts.collect()) == [
        ("pages/a.txt", 0, 0), ("pages/b.txt", 0, 20), ("pages/b.txt", 20, 20), ("pages/b.txt", 40, 10), ("pages/c.txt", 0, 0)]
