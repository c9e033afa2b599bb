"""Feed members read natively: against the one-pass reader, and the rules for headings."""

import random

import pytest

from tractlake.operators import feeds


def members(spark, *texts):
    return spark.createDataFrame([(f"m{i}.txt", bytearray(t.encode())) for i, t in enumerate(texts)],
                                 "path string, content binary")


def rows(df):
    return sorted(map(repr, df.collect()))


def test_same_rows_as_the_one_pass_reader(spark):
    rng = random.Random(11)
    texts = ["id\tyear\tdescription\n1\t1999\tplain\n", "description\tid\tyear\n\"say \"\"hi\"\"\tthere\nyou\"\t2\t2002\n",
             "year\tid\n2003\t3\n\n2004\t4\n", "id\tyear\tdescription\n5\t \t2005\td\n6\t \t2006\te\n", "", "id\n",
             "﻿id\tye-ar\tdescription\n7\t2007\tnaïve\n", "\n\nid\tyear\n8\t2008", "id\tyear\tdescription\r\n9\t2009\tx\r\n",
             "\"id\"\t\"year\"\tdescription\n10\t\t\"\"\n11\t2011\t\n", "id\tyear\tdescription\n12\n13\t2013\n",
             "id\tyear\tdescription\n14\t \t2014\ttab \"in\" it\n15\t \t2015\t\"q\tr\"\n"]
    for k in range(30):  # random members; every third needs the repair
        heads = rng.sample(["id", "year", "description"], 3)
        gap = "\t \t" if k % 3 == 0 else "\t"
        lines = []
        for i in range(rng.randrange(0, 6)):
            cell = {"id": str(100 * k + i), "year": str(rng.randrange(1900, 2020)),
                    "description": rng.choice(["a b", '"x\ty"', '"li\nne"', '"q""uo""te"', '""', "plain"])}
            lines.append(gap.join(cell[h] for h in heads))
        texts.append("\n".join(["\t".join(heads), *lines]) + "\n")
    m = members(spark, *texts)
    want = feeds.read_feed_archives(m, feeds.DICTIONARY)
    got = feeds.read_feed_members(m, feeds.DICTIONARY)
    assert got.schema == want.schema and rows(got) == rows(want) and len(rows(got)) > 60
    assert "Python" not in got._jdf.queryExecution().toString() and "InPandas" not in got._jdf.queryExecution().toString()
    plain = members(spark, "1\t1999\tx\n2\t \t2000\ty\n")
    assert rows(feeds.read_feed_members(plain, feeds.DICTIONARY, header=False)) == \
        rows(feeds.read_feed_archives(plain, feeds.DICTIONARY, header=False))


@pytest.mark.parametrize("read", [feeds.read_feed_archives, feeds.read_feed_members])
def test_headings(spark, read):
    notes = members(spark, "id\tnotes\tdescription\n1\t2001\tx\n")
    with pytest.raises(Exception, match="unknown or repeated names: notes"):  # never taken for the column in its place
        read(notes, feeds.DICTIONARY).collect()
    got = read(notes, feeds.DICTIONARY, rename={"notes": "year"}).first()
    assert (got.id, int(got.year), got.description) == ("1", 2001, "x")
    for bad in ("id\tid\n1\t2\n", "id\tyear\tnotes\tmore\n1\t2\t3\t4\n"):
        with pytest.raises(Exception, match="unknown or repeated"):
            read(members(spark, bad), feeds.DICTIONARY).collect()
    with pytest.raises(Exception, match="more fields than the header"):
        read(members(spark, "id\tyear\n1\t2\t3\n"), feeds.DICTIONARY).collect()


def test_by_position_as_a_positional_load(spark):
    got = feeds.read_feed_members(members(spark, "key\tyear\twords\n1\t2001\tx\n"), feeds.DICTIONARY, by_position=True).first()
    assert (got.id, int(got.year), got.description) == ("1", 2001, "x")
    for bad in ("key\tyear\n1\t2001\n", "year\tkey\twords\n2001\t1\tx\n"):  # fewer, or a known one out of place
        with pytest.raises(Exception, match="unknown or repeated"):
            feeds.read_feed_members(members(spark, bad), feeds.DICTIONARY, by_position=True).collect()


def test_no_members(spark):
    assert feeds.read_feed_members(spark.createDataFrame(
        [], "path string, content binary"), feeds.DICTIONARY).collect() == []
    assert feeds.read_feed_members(members(spark, "", "\n\n"), feeds.DICTIONARY).collect() == []
