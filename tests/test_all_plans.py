"""Plan checks over every query of the survey and feed operators."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL
from tractlake.plans.stored import REGISTRY

# Python opens archives and workbooks, or packs table rows into them as input.
PYTHON = {"archive_expand", "archive_chunks", "workbook_stack", "template_files_read"}
WIDTH = {"lineitem": 16, "orders": 9, "customer": 8, "part": 9, "pages": 3, "events": 6}


def explained(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: explained(fn(spark, SF_SMALL)) for name, (fn, _) in REGISTRY.items()}


def test_no_cross_joins(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]


def test_python_only_where_a_file_format_needs_it(plans):
    found = {n for n, p in plans.items() if re.search(r"InPandas|InArrow|EvalPython|PythonUDF", p)}
    assert found <= PYTHON


def test_scans_read_the_columns_they_need(plans):
    whole = []
    for name, p in plans.items():
        for location, schema in re.findall(r"Location: [^\n]*/(\w+)\.parquet\][\s\S]*?ReadSchema: struct<([^\n]*)>", p):
            read = len(re.findall(r"(?:^|,)\w+:", schema))
            if read >= WIDTH.get(location, 10 ** 6) and location != "pages":
                whole.append((name, location))
    assert not whole


def test_no_single_task_sorts_or_windows_over_rows(plans):
    """A window without a partition only runs over a row a file split."""
    single = {n for n, p in plans.items() if re.search(r"\bWindow\b[^\n]*\n(?:.*\n)*?Arguments: \[[^\]]*windowspecdefinition\((?!\w+#\d+[,)])", p)}
    assert single == {"catalog_csv_load"}
