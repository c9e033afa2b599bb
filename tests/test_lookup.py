from decimal import Decimal as D

from pyspark.sql import types as T

from tractlake.operators import lookup
from tests.conftest import rows


def test_unpivot_drops_empty_labels_keeps_order(spark):
    t = spark.createDataFrame(
        [("f", "t", "", "0", "5", "", "Total", None, 1), ("f", "t", "", "0", "5", "", "Again", "Men", 2)],
        "a string, b string, c string, d string, e string, f string, B01_001 string, "
        "B01_002 string, rowno int")
    out = lookup.unpivot_template(t, seq=5, row_col="rowno")
    assert rows(out) == [("B01_001", 5, "Total", 1), ("B01_002", 5, "Men", 2)]


def test_sequence_wide_orders_by_ordinal():
    lk = [dict(varid="B2", seq=3, ordinal=2), dict(varid="B1", seq=3, ordinal=1),
          dict(varid="X", seq=4, ordinal=1)]
    s = lookup.sequence_wide(lk, 3)
    assert s.fieldNames()[-2:] == ["B1", "B2"] and len(s.fields) == 8
    assert isinstance(s["B1"].dataType, T.DecimalType)
    assert lookup.sequence_wide(lk, 99) is None


def test_measures_long_pairs_estimates_and_margins(spark):
    sch = "year int, stusab string, logrecno string, B1 decimal(16,2), B2 decimal(16,2)"
    e = spark.createDataFrame([(2017, "al", "1", D("10"), D("20"))], sch)
    m = spark.createDataFrame([(2017, "al", "1", D("1"), None), (2017, "al", "2", D("3"), D("4"))], sch)
    out = lookup.measures_long(e, m, ["B1", "B2"])
    assert rows(out) == [
        (2017, "al", "1", "B1", D("10.00"), D("1.00")), (2017, "al", "1", "B2", D("20.00"), None),
        (2017, "al", "2", "B1", None, D("3.00")), (2017, "al", "2", "B2", None, D("4.00"))]
