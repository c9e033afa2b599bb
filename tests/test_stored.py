"""Stored tables: fact versions, bucketed joins, metric slices, streams committed with the ledger."""

import datetime as dt
import os
import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tractlake.operators import catalog as cat
from tractlake.operators import facts, ledger
from tractlake.plans import factstore, loads
from tractlake.sources import bucketed, files
from tractlake.streaming import ingest

FACT = "year int, geoid string, a decimal(16,2), b decimal(16,2)"


def fact_rows(spark, root, **kw):
    return sorted(tuple(r) for r in factstore.read(spark, root, **kw).collect())


def test_upsert_writes_only_touched_years(spark, tmp_path):
    root = str(tmp_path / "fact")
    one, n = D("1.00"), None
    assert factstore.manifest(spark, root) == {}
    with pytest.raises(ValueError, match="no stored fact"):
        factstore.read(spark, root)
    factstore.create(spark, root, spark.createDataFrame([(y, g, one, n) for y in (2016, 2017, 2018) for g in "xy"], FACT))
    before = factstore.manifest(spark, root)
    files_before = {y: sorted(os.listdir(f)) for y, f in before.items()}
    src = spark.createDataFrame([(2017, "x", D(5), n, D("0.5")), (2017, "zz", D(9), D(9), n), (2030, "x", D(9), n, n)],
                                FACT + ", c decimal(9,6)")
    assert factstore.upsert(spark, root, src) == {"version": 2, "years": [2017]}
    after = factstore.manifest(spark, root)
    assert after[2016] == before[2016] and after[2018] == before[2018] and after[2017] != before[2017]
    assert {y: sorted(os.listdir(f)) for y, f in before.items()} == files_before  # the old version is whole
    assert fact_rows(spark, root) == [(y, g, D(5) if (y, g) == (2017, "x") else one, n, D("0.5") if (y, g) == (2017, "x") else n)
                                      for y in (2016, 2017, 2018) for g in "xy"]
    assert {r[0] for r in fact_rows(spark, root, years=[2016])} == {2016}
    none = factstore.upsert(spark, root, src.filter("year = 2030"))
    assert none == {"version": 2, "years": []}
    twice = spark.createDataFrame([(2017, "x", D(1), n)] * 2, FACT)
    with pytest.raises(Exception, match="duplicate key"):
        factstore.upsert(spark, root, twice)
    assert factstore.manifest(spark, root) == after


def test_a_writer_lost_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    factstore.create(spark, root, spark.createDataFrame([(2016, "x", D(1), None)], FACT))
    src = spark.createDataFrame([(2016, "x", D(2), None)], FACT)
    with monkeypatch.context() as m:
        m.setattr(ledger, "write_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            factstore.upsert(spark, root, src)
    assert fact_rows(spark, root) == [(2016, "x", D("1.00"), None)]
    os.makedirs(f"{root}/versions/v=000000000002")  # a commit without its marker doesn't count either
    assert fact_rows(spark, root) == [(2016, "x", D("1.00"), None)]
    assert factstore.upsert(spark, root, src) == {"version": 3, "years": [2016]}
    assert fact_rows(spark, root) == [(2016, "x", D("2.00"), None)]


def test_bucketed_fact_has_no_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["fact_bucketed"](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan


def _wide_catalog(spark, n, seqs=6):
    """n metrics in two groups over measures of several sequences, with overlapping names and windows."""
    rng = random.Random(n)
    ids = [(f"B{s}_{i:03d}", s, i) for s in range(1, seqs + 1) for i in range(1, 31)]
    frames = {}
    for s in range(1, seqs + 1):
        ms = [v for v, q, _ in ids if q == s]
        rows = [(y, "al", f"{k:07d}", *[D(rng.randrange(0, 9)) if rng.random() > 0.1 else None for _ in ms])
                for y in (2016, 2017) for k in range(12) if (k + s) % 5]
        frames[s] = spark.createDataFrame(rows, "year int, stusab string, logrecno string, "
                                          + ", ".join(f"{m} decimal(16,2)" for m in ms))
    areas = spark.createDataFrame([(y, f"g{k}", "AL", f"{k:07d}") for y in (2016, 2017) for k in range(12)],
                                  "year int, geoid string, stusab string, logrecno string")
    rows = []
    for i in range(n):
        a, b = rng.sample(ids, 2)
        rows.append(dict(group_name="g1" if i % 3 else "g2", metric_name=f"m{i % (n - 10)}",
                         formula=f"{a[0]} {rng.choice('+-/')} {b[0]}", statistic="count",
                         start_year=2016 + (i % 3 == 0), end_year=9999))
    return areas, frames, [dict(varid=v, seq=s, ordinal=o) for v, s, o in ids], cat.plan_groups(rows, 2017)


def test_slices_of_a_catalog_of_160_metrics(spark):
    areas, frames, lookup_rows, plans = _wide_catalog(spark, 160)
    whole = facts.build_fact(areas, frames, lookup_rows, plans, max_fields=10 ** 6)
    sliced = facts.build_fact(areas, frames, lookup_rows, plans)
    assert len(facts.metric_slices(plans, facts.MAX_FIELDS)) > 1
    assert sliced.columns == whole.columns and len(whole.columns) == 152
    assert sorted(map(repr, sliced.collect())) == sorted(map(repr, whole.collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sliced = facts.build_fact(areas, frames, lookup_rows, plans)
        sliced.collect()
        final = sliced._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Every metric is computed in a compiled stage, and no exchange stands above a slice's join with the areas.
    made = [ln for ln in final.splitlines() if re.search(r"Project \[.* AS m\d+#", ln)]
    assert made and all(re.match(r"[\s:+\-|]*\*\(\d+\)", ln) for ln in made)
    top = [ln for ln in final.splitlines() if "Inner" in ln and "SortMergeJoin" in ln]
    assert len(top) == len(facts.metric_slices(plans, facts.MAX_FIELDS)) - 1
    first = final.splitlines().index(top[-1])
    assert not any("Exchange" in ln for ln in final.splitlines()[:first])


def test_slices_check_the_areas_key(spark):
    areas, frames, lookup_rows, plans = _wide_catalog(spark, 40)
    with pytest.raises(Exception, match="area key twice"):
        facts.build_fact(areas.unionAll(areas), frames, lookup_rows, plans, max_fields=30).collect()


def test_bucketed_tables_hold_every_row(spark, tmp_path):
    areas, frames, lookup_rows, plans = _wide_catalog(spark, 30)
    a, seqs = bucketed.load_bucketed(spark, areas, frames, "t_bucketed", 4, str(tmp_path))
    got = facts.build_fact(a, seqs, lookup_rows, plans).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, facts.build_fact(areas, frames, lookup_rows, plans).collect()))
    assert a.count() == areas.count() and len([f for f in os.listdir(f"{tmp_path}/areas") if f.endswith(".parquet")]) <= 4


def test_catalog_order_over_files_and_splits(spark, tmp_path):
    for name, first in (("b.csv", 300), ("a.csv", 0), ("c.csv", 600)):
        with open(tmp_path / name, "w") as f:
            f.write("group,name,formula,stat,first,last,notes\n")
            f.writelines(f"g,m{first + i},B1_{i:03d},count,2009,9999,{'n' * (i % 50)}\n" for i in range(300))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = {r.ordinal: r.metric_name for r in files.read_catalog(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"m{i}" for i in range(900)}
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.csv").write_text("group,name,formula,stat,first,last,notes\n")
    assert files.read_catalog(spark, str(tmp_path / "empty")).collect() == []


# ------------------------------------------------------- streams and the ledger

NOTICE = "sender string, subject string, email_ts timestamp_ntz"


class Stream:
    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)

    def land(self, day):
        self.spark.createDataFrame([("s", "Feed Update", dt.datetime(2024, 1, day, h)) for h in (1, 2)], NOTICE) \
            .coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self, checkpoint="ckpt"):
        def selected(batch):
            return ledger.select_notices(batch, "s")
        self.id = ingest.stream_with_ledger(
            self.spark, f"{self.base}/in", self.spark.createDataFrame([], NOTICE).schema, f"{self.base}/out",
            f"{self.base}/{checkpoint}", f"{self.base}/ledger", loads.LEDGER_SCHEMA,
            lambda b, led: ledger.pending_notices(selected(b), led),
            lambda b, led: ledger.close_ledger(ledger.append_unseen(led, selected(b), "2024-02-01 00:00:00"), "2024-01-31"),
            max_files=1)
        return self

    def rows(self):
        return sorted(r.email_ts.day for r in ingest.read_committed(
            self.spark, f"{self.base}/out", f"{self.base}/ledger", self.id, NOTICE + ", is_feed_update boolean").collect())

    def ledger(self):
        df = ledger.read_current(self.spark, f"{self.base}/ledger")
        return sorted((r.email_ts.day, r.updated) for r in df.collect()) if df is not None else None


def test_stream_replayed_between_the_two_writes(spark, tmp_path, monkeypatch):
    s = Stream(spark, tmp_path)
    s.land(1)
    s.run()
    assert s.rows() == [1, 1] and s.ledger() == [(1, True)] * 2
    s.land(2)
    with monkeypatch.context() as m:  # the data are written, the ledger is not
        m.setattr(ledger, "write_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            s.run()
    assert os.path.isdir(f"{tmp_path}/out/stream={s.id}/batch=1")
    assert s.rows() == [1, 1] and s.ledger() == [(1, True)] * 2  # neither moved
    s.run()
    assert s.rows() == [1, 1, 2, 2] and s.ledger() == [(1, True)] * 2 + [(2, True)] * 2


def test_stream_replayed_behind_the_commit(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.land(1)
    s.land(2)
    s.run()
    versions = ledger.current_version(spark, f"{tmp_path}/ledger")
    for f in os.listdir(f"{tmp_path}/ckpt/commits"):  # the checkpoint lost its note of the last batch
        if f.strip(".").startswith("1"):
            os.remove(f"{tmp_path}/ckpt/commits/{f}")
    s.run()
    assert ledger.current_version(spark, f"{tmp_path}/ledger") == versions
    assert s.rows() == [1, 1, 2, 2] and s.ledger() == [(1, True)] * 2 + [(2, True)] * 2


def test_another_checkpoint_is_another_stream(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.land(1)
    first = s.run().id
    s.run("other")
    assert s.id != first and s.rows() == [] and s.ledger() == [(1, True)] * 2  # all seen and done
    assert ledger.committed_batches(spark, f"{tmp_path}/ledger", first) == 1
    assert ledger.committed_batches(spark, f"{tmp_path}/ledger", s.id) == 1


def _zip(path, rating):
    import zipfile
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("ratings_al.txt", f"test-rating-id\tuniversal-id\trating\turl\n1\tU1\t{rating}\thttps://r/1\n")


def test_feed_stream_tables_and_ledger_move_together(spark, tmp_path, monkeypatch):
    from tractlake.operators import feeds
    base = str(tmp_path)
    schema = spark.createDataFrame([], NOTICE).schema

    def land(*notices):
        spark.createDataFrame([("s", subject, dt.datetime(2024, 1, day, 8)) for subject, day in notices], NOTICE) \
            .coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run():
        return loads.run_feed_stream(spark, f"{base}/in", schema, f"{base}/ledger", f"{base}/feeds", f"{base}/out",
                                     f"{base}/ckpt", {"ratings": ("*.zip", feeds.RATINGS)}, "s", "2024-02-01 00:00:00")

    def seen(stream):
        t = ingest.read_replaced(spark, f"{base}/out", f"{base}/ledger", stream, "ratings")
        led = ledger.read_current(spark, f"{base}/ledger")
        return (None if t is None else [int(r.rating) for r in t.collect()],
                sorted((r.email_ts.day, r.updated) for r in led.collect()))
    _zip(f"{base}/feeds/landing/20240105/ratings.zip", 5)
    _zip(f"{base}/feeds/landing/20240107/ratings.zip", 7)
    land(("hello", 4))
    stream = run()
    assert seen(stream) == (None, [(4, False)])  # nothing to load, the notice is kept
    land(("Feed Update", 5), ("hello", 6))
    assert run() == stream and seen(stream) == ([5], [(4, True), (5, True), (6, False)])
    land(("Feed Update", 7))
    with monkeypatch.context() as m:
        m.setattr(ledger, "write_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert seen(stream) == ([5], [(4, True), (5, True), (6, False)])  # neither the table nor the ledger moved
    assert run() == stream and seen(stream) == ([7], [(4, True), (5, True), (6, True), (7, True)])
    assert run() == stream and seen(stream) == ([7], [(4, True), (5, True), (6, True), (7, True)])


def test_runs_of_the_catalog_add_years_and_update_windows(spark, tmp_path):
    root = str(tmp_path / "fact")
    years = (2015, 2016, 2017)
    areas = spark.createDataFrame([(y, f"g{k}", "AL", str(k)) for y in years for k in (1, 2)],
                                  "year int, geoid string, stusab string, logrecno string")
    seqs = {1: spark.createDataFrame([(y, "al", "1", D(y - 2000), D(2)) for y in years],
                                     "year int, stusab string, logrecno string, B1_001 decimal(16,2), B1_002 decimal(16,2)")}
    lookup_df = spark.createDataFrame([("B1_001", 1, 1), ("B1_002", 1, 2)], "varid string, seq int, ordinal int")
    catalog_df = spark.createDataFrame(
        [("a", "x", "B1_001", "count", 2015, 2016), ("b", "x", "B1_002", "count", 2016, 9999),
         ("b", "y", "B1_001 / B1_002", "rate", 2016, 9999), ("late", "z", "B1_001", "count", 2030, 9999)],
        "group_name string, metric_name string, formula string, statistic string, start_year int, end_year int")

    def run(keep, groups):
        return loads.update_fact_store(spark, root, areas.filter(F.col("year").isin(keep)), seqs, lookup_df, catalog_df, 2017, groups)
    assert run([2015, 2016], ["a"]) == {"added": [2015, 2016], "updated": [2015, 2016]}
    assert run(list(years), ["B "]) == {"added": [2017], "updated": [2016, 2017]}
    got = {(r.year, r.geoid): (r.x, r.y) for r in factstore.read(spark, root).collect()}
    assert got == {(2015, "g1"): (D(15), None), (2015, "g2"): (None, None), (2016, "g1"): (D(2), D("8.000000")),
                   (2016, "g2"): (None, None), (2017, "g1"): (D(2), D("8.500000")), (2017, "g2"): (None, None)}
    assert run(list(years), ["late"]) == {"added": [], "updated": []}
    with pytest.raises(cat.CatalogError, match="groups not in the catalog: nope"):
        run(list(years), ["nope"])
    before = factstore.manifest(spark, root)
    assert run(list(years), ["a"])["updated"] == [2015, 2016] and factstore.manifest(spark, root)[2017] == before[2017]
