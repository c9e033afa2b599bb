from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tractlake.operators import catalog as cat
from tractlake.operators import facts
from tests.conftest import rows

SEQ_SCHEMA = "stusab string, logrecno string, year int, {} decimal(16,2)"


def seq(spark, name, data):
    return spark.createDataFrame(data, SEQ_SCHEMA.format(name))


@pytest.fixture
def three(spark):
    a = seq(spark, "B1_001", [("al", "0000001", 2017, D("1")), ("al", "0000002", 2017, D("2"))])
    b = seq(spark, "B2_001", [("al", "0000002", 2017, D("20")), ("al", "0000003", 2017, D("30"))])
    c = seq(spark, "C3_001", [("al", "0000003", 2017, D("300")), ("al", "0000004", 2017, D("400"))])
    return a, b, c


def test_union_and_full_join_agree(three):
    u = facts.join_sequences(list(three))
    f = facts.join_sequences(list(three), strategy="full")
    cols = ["year", "stusab_key", "logrecno", "B1_001", "B2_001", "C3_001"]
    assert rows(u, *cols) == rows(f, *cols)
    assert u.count() == 4  # every key of every sequence survives


def test_reference_chain_loses_rows_ours_keeps(three):
    """A chain that compares each sequence with the previous one only and
    keeps the first sequence's keys loses keys absent from the first."""
    a, b, c = three
    chained = (a.alias("a").join(b.alias("b"), (F.col("a.logrecno") == F.col("b.logrecno")), "full")
               .join(c.alias("c"), F.col("b.logrecno") == F.col("c.logrecno"), "full")
               .select(F.col("a.logrecno").alias("logrecno")))
    lost = chained.filter(F.col("logrecno").isNull()).count()
    assert lost == 2
    ours = facts.join_sequences(list(three))
    assert ours.filter(F.col("logrecno").isNull()).count() == 0


def test_duplicate_key_in_sequence_fails(spark, three):
    a, b, _ = three
    dup = a.unionByName(a)
    with pytest.raises(Exception, match="duplicate key"):
        facts.join_sequences([dup, b]).collect()


GEO = [(2017, "14000US1", "AL", "0000001"), (2017, "14000US2", "AL", "0000002"),
       (2017, "14000US9", "AL", "0000009"), (2016, "14000US1", "AL", "0000001")]


def geo_df(spark):
    return spark.createDataFrame(GEO, "year int, geoid string, stusab string, logrecno string")


def test_attach_area_keeps_every_area_with_its_year(spark, three):
    data = facts.prune_measures(three[0], ["B1_001"])
    out = facts.attach_area(data, geo_df(spark), ["B1_001"])
    assert rows(out) == [(2016, "14000US1", None), (2017, "14000US1", D("1.00")),
                         (2017, "14000US2", D("2.00")), (2017, "14000US9", None)]


def test_upsert_never_overwrites_with_null_and_rejects_duplicates(spark):
    fact = spark.createDataFrame([(2017, "g1", D("1")), (2017, "g2", D("2"))],
                                 "year int, geoid string, m decimal(16,2)")
    src = spark.createDataFrame([(2017, "g1", None), (2017, "g2", D("5"))],
                                "year int, geoid string, m decimal(16,2)")
    assert rows(facts.upsert_fact(fact, src)) == [(2017, "g1", D("1.00")), (2017, "g2", D("5.00"))]
    with pytest.raises(Exception, match="duplicate"):
        facts.upsert_fact(fact, src.unionByName(src)).collect()


LOOKUP = [dict(varid="B1_001", seq=1, ordinal=1), dict(varid="B2_001", seq=2, ordinal=1),
          dict(varid="C3_001", seq=3, ordinal=1), dict(varid="B1_001", seq=7, ordinal=1)]


def test_build_fact_last_group_wins_and_windows(spark, three):
    catalog = [
        dict(group_name="a", metric_name="m", formula="B1_001", statistic="count",
             start_year=2010, end_year=9999),
        dict(group_name="b", metric_name="m", formula="B2_001", statistic="count",
             start_year=2010, end_year=9999),
        dict(group_name="b", metric_name="r", formula="B1_001 / B2_001", statistic="rate",
             start_year=2010, end_year=9999),
        dict(group_name="c", metric_name="old", formula="C3_001", statistic="count",
             start_year=2009, end_year=2010),
    ]
    plans = cat.plan_groups(catalog, 2017)
    seqs = {1: three[0], 2: three[1], 3: three[2]}
    out = facts.build_fact(geo_df(spark), seqs, LOOKUP, plans)
    got = {(r.year, r.geoid): (r.m, r.r, r.old) for r in out.collect()}
    assert got[(2017, "14000US1")] == (D("1.00"), None, None)       # b NULL → a kept
    assert got[(2017, "14000US2")] == (D("20.00"), D("0.100000"), None)  # b wins
    assert got[(2017, "14000US9")] == (None, None, None)            # no data
    assert len(got) == len(GEO)


def test_group_frame_empty_window_and_unknown_measure(spark, three):
    seqs = {1: three[0], 2: three[1], 3: three[2]}
    p = cat.plan_groups([dict(group_name="g", metric_name="x", formula="B1_001", statistic="count",
                              start_year=2009, end_year=2010)], 2008)[0]
    assert p.empty
    assert facts.group_frame(p, seqs, LOOKUP, geo_df(spark)).count() == 0
    bad = cat.plan_groups([dict(group_name="g", metric_name="x", formula="B9_009",
                                statistic="count", start_year=2009, end_year=9999)], 2017)[0]
    with pytest.raises(cat.CatalogError, match="B9_009"):
        facts.group_frame(bad, seqs, LOOKUP, geo_df(spark))


def test_lowest_sequence_wins():
    assert list(facts.measure_homes(["B1_001"], LOOKUP)["B1_001"]) == [1]


def test_name_in_three_groups_last_non_null_wins(spark, three):
    catalog = [dict(group_name=g, metric_name="m", formula=f, statistic="count",
                    start_year=2010, end_year=9999)
               for g, f in (("a", "B1_001"), ("b", "B2_001"), ("c", "C3_001"))]
    plans = cat.plan_groups(catalog, 2017)
    seqs = {1: three[0], 2: three[1], 3: three[2]}
    geo4 = spark.createDataFrame(GEO + [(2017, "14000US3", "AL", "0000003")],
                                 "year int, geoid string, stusab string, logrecno string")
    out = {r.geoid: r.m for r in facts.build_fact(geo4, seqs, LOOKUP, plans).collect()
           if r.year == 2017}
    assert out == {"14000US1": D("1.00"), "14000US2": D("20.00"), "14000US3": D("300.00"),
                   "14000US9": None}


def test_wide_catalog_beyond_codegen_field_limit(spark):
    """132 metrics over 12 sequences (more than spark.sql.codegen.maxFields)
    against a brute-force computation in plain Python."""
    keys = [("al", "000000%d" % i) for i in range(1, 4)]
    seqs, lk, catalog, expect = {}, [], [], {}
    for s in range(1, 13):
        ms = [f"B{s:02d}_{j:03d}" for j in range(1, 11)]
        data = []
        for n, (code, rec) in enumerate(keys):
            if s % 4 == 0 and n == 2:
                continue  # a record missing from some sequences
            data.append((code, rec, 2017, *[D(s * 100 + j * 10 + n) for j in range(1, 11)]))
        seqs[s] = spark.createDataFrame(
            data, "stusab string, logrecno string, year int, "
            + ", ".join(f"{m} decimal(16,2)" for m in ms))
        lk += [dict(varid=m, seq=s, ordinal=j) for j, m in enumerate(ms, 1)]
        for j, m in enumerate(ms, 1):
            catalog.append(dict(group_name=f"g{s:02d}", metric_name=f"m{s}_{j}", formula=m,
                                statistic="count", start_year=2017, end_year=9999))
        catalog.append(dict(group_name=f"g{s:02d}", metric_name=f"r{s}",
                            formula=f"m{s}_1 / ({ms[1]} + m{s}_3)", statistic="rate",
                            start_year=2017, end_year=9999))
        for n, (code, rec) in enumerate(keys):
            present = not (s % 4 == 0 and n == 2)
            for j in range(1, 11):
                expect[(rec, f"m{s}_{j}")] = D(s * 100 + j * 10 + n) if present else None
            if present:
                num, den = D(s * 100 + 10 + n), D(s * 100 + 20 + n) + D(s * 100 + 30 + n)
                expect[(rec, f"r{s}")] = (num / den).quantize(D("0.000001"), rounding=ROUND_HALF_UP)
            else:
                expect[(rec, f"r{s}")] = None
    areas = spark.createDataFrame([(2017, f"g{rec}", code.upper(), rec) for code, rec in keys],
                                  "year int, geoid string, stusab string, logrecno string")
    plans = cat.plan_groups(catalog, 2017)
    out = facts.build_fact(areas, seqs, lk, plans)
    assert len(out.columns) == 2 + 132
    got = {}
    for r in out.collect():
        for k, v in r.asDict().items():
            if k not in ("year", "geoid"):
                got[(r.geoid[1:], k)] = v
    assert got == expect


def test_fact_with_one_region_holding_most_rows(spark):
    """A hot region code: the keys still include the record number, so the
    fold stays exact (and evenly hashed)."""
    n = 3000
    seq = spark.range(n).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 'hot' ELSE concat('r', CAST(id % 5 AS STRING)) END AS stusab",
        "lpad(CAST(id AS STRING), 7, '0') AS logrecno", "2017 AS year",
        "CAST(id AS DECIMAL(16,2)) AS B1_001")
    areas = seq.selectExpr("year", "concat('g', logrecno) AS geoid", "upper(stusab) AS stusab",
                           "logrecno")
    plans = cat.plan_groups([dict(group_name="g", metric_name="v", formula="B1_001 + 1",
                                  statistic="count", start_year=2017, end_year=9999)], 2017)
    out = facts.build_fact(areas, {1: seq}, [dict(varid="B1_001", seq=1, ordinal=1)], plans)
    got = out.selectExpr("count(*) AS n", "sum(v) AS s", "count(v) AS nv").first()
    assert (got.n, got.nv, got.s) == (n, n, D(n * (n - 1) // 2 + n))
