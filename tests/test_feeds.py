from decimal import Decimal as D

import pytest

from tractlake.operators import feeds
from tests.conftest import rows


def test_tsv_repair_only_files_that_fail(spark):
    lines = spark.createDataFrame([
        ("clean.txt", "1\t \tx\ty"),            # legal blank field: left alone
        ("clean.txt", "2\ta\tb\tc"),
        ("dirty.txt", "3\ta\t \tb\tc"),          # stray tab-blank-tab: repaired
        ("dirty.txt", "4\t \tb\tc"),             # legal blank, collapsed in a dirty file
    ], "file string, value string")
    out = feeds.read_tsv_repaired(lines, ["id", "a", "b", "c"])
    assert rows(out) == [("clean.txt", "1", " ", "x", "y"), ("clean.txt", "2", "a", "b", "c"),
                         ("dirty.txt", "3", "a", "b", "c"), ("dirty.txt", "4", "b", "c", None)]


def test_tsv_still_too_wide_fails(spark):
    lines = spark.createDataFrame([("f", "1\t2\t3\t4\t5")], "file string, value string")
    with pytest.raises(Exception, match="more fields"):
        feeds.read_tsv_repaired(lines, ["a", "b"]).collect()


def test_union_drift_and_clean_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, `na-me` string")
    b = spark.createDataFrame([("y", 2.5, 2)], "`na-me` string, score double, id int")
    u = feeds.clean_columns(feeds.union_drift([a, b]))
    assert u.columns == ["id", "name", "score"]
    assert rows(u) == [(1, "x", None), (2, "y", 2.5)]


def _city(spark, **over):
    base = dict(id="1", name="Town", state="CA", rating="7", url="u", lat="37.5", lon="-122.25",
                active="1")
    base.update(over)
    cols = [n for n, _, _ in feeds.CITY_RATINGS]
    return spark.createDataFrame([tuple(base[c] for c in cols)], ", ".join(f"{c} string" for c in cols))


def test_typed_load(spark):
    r = feeds.typed_load(_city(spark, rating=""), feeds.CITY_RATINGS).collect()[0]
    assert r.rating is None and r.lat == D("37.500000") and r.active == D("1")


@pytest.mark.parametrize("over, msg", [(dict(state="CAL"), "longer"),
                                       (dict(rating="abc"), "CAST"), (dict(rating="123"), "")])
def test_typed_load_failures(spark, over, msg):
    with pytest.raises(Exception, match=msg or None):
        feeds.typed_load(_city(spark, **over), feeds.CITY_RATINGS).collect()


def test_feed_layout_widths():
    assert len(feeds.DIRECTORY) == 30 and len(feeds.RATINGS) == 4
    assert len(feeds.CITY_RATINGS) == 8 and len(feeds.DICTIONARY) == 3


def test_salted_join_same_result_as_plain_join(spark):
    from tractlake.operators.skew import salted_lookup_join
    big = spark.range(2000).selectExpr("CASE WHEN id % 10 < 8 THEN 'hot' ELSE cast(id % 7 AS string) END AS k",
                                       "id")
    small = big.groupBy("k").count()
    plain = rows(big.join(small, "k"))
    salted = rows(salted_lookup_join(big, small, ["k"], buckets=8))
    assert plain == salted
