"""Plan checks: pruned scans, pushed filters, no Python on the data path
outside archives and workbooks, no Cartesian products."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "PythonUDF")
PY_ALLOWED = {"archive_expand", "workbook_stack"}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    q = E.queries()
    for name in ("fact_full", "metric_by_area", "feed_scan_by_date", "sequence_full_outer",
                 "geo_levels", "ledger_pending", "feed_tsv_repair", "archive_expand"):
        out[name] = plan(q[name](spark, SF_SMALL))
    return out


def test_no_python_outside_archives(plans):
    for name, p in plans.items():
        if name not in PY_ALLOWED:
            assert not any(n in p for n in PY_NODES), name
    assert "MapInPandas" in plans["archive_expand"]


def test_no_cartesian_products(plans):
    for p in plans.values():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_lineitem_scan_is_pruned(plans):
    p = plans["fact_full"]
    schemas = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert schemas
    for ln in schemas:
        assert "l_comment" not in ln and "l_tax" not in ln and "l_suppkey" not in ln


def test_date_filter_pushed_to_scan(plans):
    p = plans["feed_scan_by_date"]
    pushed = [ln for ln in p.splitlines() if "PushedFilters" in ln]
    assert any("ts" in ln and "GreaterThanOrEqual" in ln for ln in pushed)


def test_fact_fold_single_combine(plans):
    # the measures of all sequences are combined by one aggregate, then the
    # areas join them once; no sort-merge chain of full outer joins
    p = plans["fact_full"]
    assert "FullOuter" not in p


def test_fact_fold_shuffles_areas_once_without_broadcast(spark):
    """Large-input plan: the areas are exchanged once and each sequence is
    left-joined without re-shuffling the growing result."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["fact_full"](spark, SF_SMALL)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    top = [ln for ln in final.splitlines() if "LeftOuter" in ln]
    assert len(top) == 3  # one left join per sequence
    area_exchanges = [ln for ln in final.splitlines()
                      if "Exchange hashpartitioning(year" in ln and "stusab_key" in ln]
    # one exchange for the areas + one per sequence (its uniqueness aggregate)
    assert len(area_exchanges) == 1 + 3


def test_tsv_repair_join_is_salted(plans):
    p = plans["feed_tsv_repair"]
    joins = [ln for ln in p.splitlines() if ln.startswith("Left keys") and "_salt" in ln]
    assert joins, "the per-file width join should be on (file, salt)"
