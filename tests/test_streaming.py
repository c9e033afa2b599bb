import tempfile

from pyspark.sql import functions as F

from tractlake.streaming import ingest
from tests.conftest import SF_SMALL, rows


def test_stream_twice_same_rows_and_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    landing = tempfile.mkdtemp(prefix="tl-land-")
    ev.repartition(3).write.mode("overwrite").parquet(landing)
    out, ckpt = tempfile.mkdtemp(prefix="tl-out-"), tempfile.mkdtemp(prefix="tl-ck-")

    def clean(s):
        return ingest.dedupe_notices(s.filter(F.col("event_type") == "signup"), "ts", ["event_id"],
                                     "3650 days")

    n1 = ingest.stream_ingest(spark, landing, ev.schema, out, ckpt, clean, max_files=1)
    first = rows(ingest.read_ingested(spark, out))
    n2 = ingest.stream_ingest(spark, landing, ev.schema, out, ckpt, clean)
    assert n1 >= 1 and n2 == 0
    assert rows(ingest.read_ingested(spark, out)) == first
    batch = ev.filter(F.col("event_type") == "signup")
    assert first == rows(batch.select(*ingest.read_ingested(spark, out).columns))


def test_dedupe_within_watermark_drops_repeats(spark):
    import datetime as dt
    rows_in = [(1, dt.datetime(2024, 1, 1, 9), "a"), (1, dt.datetime(2024, 1, 1, 9), "a"),
               (2, dt.datetime(2024, 1, 2, 9), "b")]
    schema = "event_id long, ts timestamp_ntz, subject string"
    landing = tempfile.mkdtemp(prefix="tl-dup-")
    spark.createDataFrame(rows_in, schema).write.mode("overwrite").parquet(landing)
    out, ckpt = tempfile.mkdtemp(prefix="tl-dup-out-"), tempfile.mkdtemp(prefix="tl-dup-ck-")
    src = spark.read.parquet(landing)
    ingest.stream_ingest(spark, landing, src.schema, out, ckpt,
                         lambda s: ingest.dedupe_notices(s, "ts", ["event_id"], "7 days"))
    got = rows(ingest.read_ingested(spark, out), "event_id", "subject")
    assert got == [(1, "a"), (2, "b")]
