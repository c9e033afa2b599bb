"""Incremental feed ingest with Structured Streaming.

The periodic poll becomes a file-source stream with a checkpoint: each run
with ``trigger(availableNow=True)`` picks up the files that arrived since the
last run, once, and stops. ``foreachBatch`` writes each micro-batch into a
folder named by its batch id with overwrite, so a batch replayed after a
failure replaces its own output instead of adding a copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.operators import ledger


def dedupe_notices(df: DataFrame, ts: str, keys, delay: str) -> DataFrame:
    """Drop repeated notices within the watermark delay.

    Opt-in: a row whose event time is older than the watermark (the latest
    event time seen minus ``delay``) is late and is dropped, so ``delay``
    must cover how far out of time order files can arrive. The default
    ingest path does not dedupe; the checkpoint already reads each file once.
    ``withWatermark`` needs a zoned timestamp; stored timestamps without
    zone are cast first (the session zone is UTC).
    """
    t = df.withColumn("_event_time", F.col(ts).cast("timestamp"))
    return (t.withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(list(keys)).drop("_event_time"))


def stream_ingest(spark: SparkSession, source: str, schema: T.StructType, out: str,
                  checkpoint: str, transform=None, fmt: str = "parquet",
                  glob: str | None = None, max_files: int | None = None) -> int:
    """Run one incremental pass; return the number of batches committed.

    A second call with the same ``checkpoint`` finds no new files and adds
    nothing.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    stream = r.load(source)
    if transform is not None:
        stream = transform(stream)
    batches = []

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def read_ingested(spark: SparkSession, out: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(out).drop("batch")


QUERY_ID = "sql.streaming.queryId"


def stream_with_ledger(spark: SparkSession, source: str, schema: T.StructType, out: str,
                       checkpoint: str, ledger_root: str, ledger_schema, rows, advance,
                       fmt: str = "parquet", glob: str | None = None,
                       max_files: int | None = None) -> str:
    """One incremental pass whose data and ledger are committed together.

    For every micro-batch, ``rows(batch, ledger)`` gives the rows to keep, or a
    dict of tables, and ``advance(batch, ledger)`` the next ledger. The rows are written to a
    folder of the stream's id and the batch's number (and the table's name); then one write adds the
    ledger version, whose folder names that batch. That write is the commit:

    * a crash before it leaves neither (readers ask the ledger which batches
      count), and the replay of the batch, which the checkpoint guarantees to
      hold the same files, replaces the rows;
    * a crash behind it, before the checkpoint notes the batch, replays a batch
      that the ledger has, which is skipped.

    The id comes from the checkpoint, so a new checkpoint is another stream
    and never mistaken for a replay. Returns the id; see :func:`read_committed`.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int):
        stream = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if batch_id < ledger.committed_batches(spark, ledger_root, stream):
            return
        current = ledger.read_current(spark, ledger_root, ledger_schema)
        if current is None:
            current = spark.createDataFrame([], ledger_schema)
        made = rows(batch, current)
        for name, df in (made if isinstance(made, dict) else {None: made}).items():
            df.write.mode("overwrite").parquet(_batch_folder(out, stream, batch_id, name))
        ledger.write_snapshot(advance(batch, current), ledger_root,
                              ledger.next_version(spark, ledger_root), f"{stream}-{batch_id}")

    q = (r.load(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return str(q.id)


def _batch_folder(out: str, stream: str, batch, table: str | None = None) -> str:
    return f"{out}/stream={stream}/batch={batch}" + (f"/table={table}" if table else "")


def read_committed(spark: SparkSession, out: str, ledger_root: str, stream: str, schema) -> DataFrame:
    """The rows of the batches that the ledger has committed; those of a lost batch don't count."""
    n = ledger.committed_batches(spark, ledger_root, stream)
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_batch_folder(out, stream, b) for b in range(n)])


def read_replaced(spark: SparkSession, out: str, ledger_root: str, stream: str, table: str) -> DataFrame | None:
    """A table that every batch replaces: as the newest committed batch that has it wrote it."""
    n = ledger.committed_batches(spark, ledger_root, stream)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_batch_folder(out, stream, "*", table))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    batches = [int(s.getPath().getParent().getName().partition("=")[2]) for s in fs.globStatus(path) or []]
    newest = max((b for b in batches if b < n), default=None)
    return None if newest is None else spark.read.parquet(_batch_folder(out, stream, newest, table))
