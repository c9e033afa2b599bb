import datetime as dt

from tractlake.operators import ledger
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 9)
LEDGER = "retrieve_ts timestamp_ntz, email_ts timestamp_ntz, email_subject string, " \
         "is_feed_update boolean, updated boolean, stage_location string"
NOTICE = "sender string, subject string, email_ts timestamp_ntz"


def ts(day, hour=9):
    return dt.datetime(2024, 1, day, hour)


def setup(spark):
    led = spark.createDataFrame([
        (T0, ts(1), "Feed Update a", True, True, "landing/20240101"),    # seen and done
        (T0, ts(2), "Feed Update b", True, False, "landing/20240102"),   # seen, not done
    ], LEDGER)
    msgs = spark.createDataFrame([
        ("feeds", "Feed Update a", ts(1)), ("feeds", "Feed Update b", ts(2)),
        ("feeds", "Feed Update c", ts(5)), ("feeds", "hello", ts(6)),
        ("other", "Feed Update z", ts(7)),
    ], NOTICE)
    return led, ledger.select_notices(msgs, "feeds")


def test_pending_and_current_batch(spark):
    led, sel = setup(spark)
    pend = ledger.pending_notices(sel, led)
    assert sorted(r.subject for r in pend.collect()) == ["Feed Update b", "Feed Update c"]
    cur = ledger.current_batch(pend).collect()[0]
    assert cur.stage_location == "landing/20240105" and cur.batch_date == dt.date(2024, 1, 5)


def test_append_close_rerun(spark):
    led, sel = setup(spark)
    app = ledger.append_unseen(led, sel, "2024-02-01 00:00:00")
    assert app.count() == 4  # unseen feed and unseen non-feed added
    closed = ledger.close_ledger(app, "2024-01-05")
    assert sorted(r.updated for r in closed.collect()) == [False, True, True, True]
    again = ledger.append_unseen(closed, sel, "2024-02-02 00:00:00")
    assert rows(again) == rows(closed)  # rerun adds nothing
    only = ledger.close_ledger(app, "2024-01-06", only_feed=True)
    assert {r.email_subject: r.updated for r in only.collect()}["hello"] is False


def test_nothing_pending(spark):
    led, sel = setup(spark)
    done = ledger.close_ledger(ledger.append_unseen(led, sel, "2024-02-01 00:00:00"), "2024-01-31")
    pend = ledger.pending_notices(sel, done)
    assert pend.count() == 0
    assert ledger.current_batch(pend).collect()[0].stage_location is None


def test_snapshot_versions_switch(spark):
    import tempfile
    led, sel = setup(spark)
    root = tempfile.mkdtemp(prefix="tl-ledger-")
    assert ledger.read_current(spark, root) is None
    ledger.write_snapshot(led, root, 1)
    cur = ledger.read_current(spark, root)
    nxt = ledger.close_ledger(ledger.append_unseen(cur, sel, "2024-02-01 00:00:00"), "2024-01-31")
    ledger.write_snapshot(nxt, root, 2)
    assert ledger.current_version(spark, root) == 2
    assert ledger.read_current(spark, root).count() == 4
    assert all(r.updated for r in ledger.read_current(spark, root).collect())
