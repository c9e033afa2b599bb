import pytest
from pyspark.sql import functions as F

from tractlake.operators import catalog as cat
from tests.conftest import rows


def test_guard_division_forms(spark):
    df = spark.createDataFrame([("a / b",), ("a/(b + c)",), ("a + b",), ("a / b + c",)], "formula string")
    got = [r[0] for r in df.select(cat.guard_division("formula")).collect()]
    assert got == ["a / NULLIF(b, 0)", "a/ NULLIF((b + c), 0)", "a + b", "a / NULLIF(b, 0) + c"]
    assert cat.guard_text("x / (y - z)") == "x / NULLIF((y - z), 0)"


def test_guarded_zero_and_null_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(F.expr(cat.guard_text("a / b"))).collect()]
    assert got == [None, None, 1.5]


def test_extract_measures_distinct_per_group(spark):
    c = spark.createDataFrame([("g", "B01_001 + C02_003"), ("g", "B01_001 / x"), ("h", "count_a")],
                              "group_name string, formula string")
    assert rows(cat.extract_measures(c)) == [("g", "B01_001"), ("g", "C02_003")]


CAT = [
    dict(group_name="g2", metric_name="Total ", formula="B01_001", statistic="count",
         start_year=2009, end_year=9999),
    dict(group_name="g2", metric_name="share", formula="B01_002 / total", statistic="rate",
         start_year=2011, end_year=9999),
    dict(group_name="g1", metric_name="total", formula="B01_003", statistic="count",
         start_year=2009, end_year=2010),
]


def test_plan_groups_windows_names_and_chains():
    plans = cat.plan_groups(CAT, 2017)
    assert [p.name for p in plans] == ["g1", "g2"]
    g1, g2 = plans
    assert (g1.first_year, g1.last_year) == (2009, 2010)
    assert (g2.first_year, g2.last_year) == (2011, 2017)
    assert dict(g2.metrics)["share"] == "B01_002 / NULLIF((B01_001), 0)"
    assert g2.types == {"total": "decimal(16,2)", "share": "decimal(9,6)"}
    assert cat.plan_groups(CAT, 2017, (2017, 2017))[0].first_year == 2017


def test_forward_reference_and_unknown_name_raise():
    bad = [dict(group_name="g", metric_name="a", formula="b + 1", statistic="count",
                start_year=2009, end_year=9999),
           dict(group_name="g", metric_name="b", formula="B01_001", statistic="count",
                start_year=2009, end_year=9999)]
    with pytest.raises(cat.CatalogError):
        cat.plan_groups(bad, 2017)


def test_two_types_raise():
    bad = [dict(group_name="g", metric_name="a", formula="B01_001", statistic="count",
                start_year=2009, end_year=9999),
           dict(group_name="h", metric_name="A ", formula="B01_001", statistic="rate",
                start_year=2009, end_year=9999)]
    with pytest.raises(cat.CatalogError):
        cat.plan_groups(bad, 2017)


def test_table_ops(spark):
    c = spark.createDataFrame([(r["group_name"], r["metric_name"], r["formula"], r["statistic"],
                                r["start_year"], r["end_year"]) for r in CAT],
                              "group_name string, metric_name string, formula string, "
                              "statistic string, start_year int, end_year int")
    closed = cat.close_open_years(c, 2017)
    assert sorted(r.end_year for r in closed.collect()) == [2010, 2017, 2017]
    assert rows(cat.group_windows(c, 2017)) == [("g1", 2009, 2010), ("g2", 2011, 2017)]
    assert rows(cat.metric_types(c.filter(F.col("group_name") == "g2"))) == [
        ("share", "decimal(9,6)"), ("total", "decimal(16,2)")]
    with pytest.raises(Exception, match="two types"):
        bad = c.union(spark.createDataFrame([("g3", "share", "B1_1", "count", 2009, 9999)], c.schema))
        cat.metric_types(bad).collect()


# Formula shapes as they occur in a survey metric catalog.
SHAPES = [
    ("B15002_011 + B15002_028", "B15002_011 + B15002_028"),
    ("count_civilian_labor_force_unemployed / count_civilian_labor_force",
     "count_civilian_labor_force_unemployed / NULLIF(count_civilian_labor_force, 0)"),
    ("B25004_004 / (B25003_002 + B25004_004 + B25004_005)",
     "B25004_004 / NULLIF((B25003_002 + B25004_004 + B25004_005), 0)"),
    ("count_population_16yr_and_over - count_in_labor_force",
     "count_population_16yr_and_over - count_in_labor_force"),
]


@pytest.mark.parametrize("formula, guarded", SHAPES)
def test_guard_on_catalog_shapes(formula, guarded):
    assert cat.guard_text(formula) == guarded


def test_chained_sums_expand_in_order():
    rows_ = [dict(group_name="edu", metric_name="a", formula="B15002_014 + B15002_031",
                  statistic="count", start_year=2009, end_year=9999),
             dict(group_name="edu", metric_name="b", formula="B15002_015 + B15002_032",
                  statistic="count", start_year=2009, end_year=9999),
             dict(group_name="edu", metric_name="a_or_b", formula="a + b", statistic="count",
                  start_year=2009, end_year=9999),
             dict(group_name="edu", metric_name="share", formula="a / a_or_b", statistic="rate",
                  start_year=2009, end_year=9999)]
    p = cat.plan_groups(rows_, 2017)[0]
    m = dict(p.metrics)
    assert m["a_or_b"] == "(B15002_014 + B15002_031) + (B15002_015 + B15002_032)"
    assert m["share"].startswith("(B15002_014 + B15002_031) / NULLIF(")
    assert p.measures == ["B15002_014", "B15002_015", "B15002_031", "B15002_032"]


def test_chained_formula_values(spark):
    from decimal import Decimal as D
    rows_ = [dict(group_name="g", metric_name="t", formula="B1_001 + B1_002", statistic="count",
                  start_year=2009, end_year=9999),
             dict(group_name="g", metric_name="r", formula="B1_001 / t", statistic="rate",
                  start_year=2009, end_year=9999)]
    p = cat.plan_groups(rows_, 2017)[0]
    df = spark.createDataFrame([(D("1"), D("2")), (D("0"), D("0"))], "B1_001 decimal(16,2), B1_002 decimal(16,2)")
    got = df.select(*[F.expr(sql).cast(p.types[n]).alias(n) for n, sql in p.metrics]).collect()
    assert [(r.t, r.r) for r in got] == [(D("3.00"), D("0.333333")), (D("0.00"), None)]
