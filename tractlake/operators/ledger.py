"""Feed-notice ledger: which notices are new, pending, and done.

The ledger is a small table keyed by the notice timestamp. Parquet tables
cannot be updated in place, so each operator returns the next snapshot; the
caller writes it to a new folder and switches to it after the feed tables
are written (ledger last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractlake.functions.columns import batch_date, batch_folder

LEDGER_COLUMNS = ["retrieve_ts", "email_ts", "email_subject", "is_feed_update",
                  "updated", "stage_location"]
DEFAULT_PHRASE = "Feed Update"
DEFAULT_PREFIX = "landing/"


def select_notices(msgs: DataFrame, sender: str, phrase: str = DEFAULT_PHRASE) -> DataFrame:
    """Notices of one sender, flagged when the subject names the feed."""
    return (msgs.filter(F.col("sender") == sender)
            .withColumn("is_feed_update", F.col("subject").contains(phrase)))


def pending_notices(notices: DataFrame, ledger: DataFrame) -> DataFrame:
    """Feed notices not yet done: unseen ones and seen-but-not-done retries.

    Anti join against the ledger's done rows on the notice timestamp.
    """
    # distinct keys: the aggregate is hash-partitioned on the join key, so
    # the anti join adds no exchange on this side
    done = ledger.filter(F.col("updated")).select(F.col("email_ts")).distinct()
    return notices.join(done, "email_ts", "left_anti").filter(F.col("is_feed_update"))


def append_unseen(ledger: DataFrame, notices: DataFrame, retrieve_ts,
                  prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Ledger plus every notice whose timestamp it lacks (feed or not).

    New rows start not done, with their landing folder.
    """
    new = notices.join(ledger.select("email_ts").distinct(), "email_ts", "left_anti")
    rows = new.select(
        F.lit(retrieve_ts).cast("timestamp_ntz").alias("retrieve_ts"),
        F.col("email_ts"), F.col("subject").alias("email_subject"),
        F.col("is_feed_update"), F.lit(False).alias("updated"),
        batch_folder("email_ts", prefix).alias("stage_location"))
    return ledger.select(*LEDGER_COLUMNS).unionByName(rows)


def close_ledger(ledger: DataFrame, day, only_feed: bool = False) -> DataFrame:
    """Mark done every row whose notice date is on or before ``day``.

    By default all such rows are marked, feed or not; ``only_feed`` limits
    it to feed notices.
    """
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    hit = F.to_date("email_ts") <= d
    if only_feed:
        hit = hit & F.col("is_feed_update")
    return ledger.withColumn("updated", F.when(hit, F.lit(True)).otherwise(F.col("updated")))


def current_batch(pending: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """The landing folder of the newest pending feed notice, and its date.

    One row; both columns NULL when nothing is pending (the batch stops).
    A global ``max_by`` is a partial aggregate: each task keeps one row.
    """
    folder = batch_folder("email_ts", prefix)
    agg = pending.agg(F.max_by(folder, F.col("email_ts")).alias("stage_location"))
    return agg.select("stage_location", batch_date("stage_location").alias("batch_date"))


# ---------------------------------------------------------------- snapshots

VERSION_COL = "v"


def _folder(version: int, batch: str | None = None) -> str:
    return f"{VERSION_COL}={version:012d}" + (f".{batch}" if batch else "")


def write_snapshot(df: DataFrame, root: str, version: int, batch: str | None = None) -> str:
    """Write the next ledger version to its own folder ``root/v=<version>``.

    A version folder is written once and never rewritten, so readers of the
    current version are never disturbed; rerunning a failed write of the same
    version replaces only that folder. Write the feed tables first and the
    ledger last: a crash in between leaves the old version current, and the
    rerun picks the same notices up again. ``batch`` names the stream batch
    that the version commits; it is part of the folder's name, so the batch and
    the ledger are committed by the same write.
    """
    path = f"{root}/{_folder(version, batch)}"
    df.write.mode("overwrite").parquet(path)
    return path


def _versions(spark, root: str, committed: bool = True) -> list:
    """(version, batch or "", folder) below ``root``, from a listing of its folders.

    A version counts once its folder has the writer's commit marker; what a
    lost write left behind doesn't. Only a missing root means that there is
    no ledger: any other failure is raised, so history is never started anew
    over a ledger that can't be read.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{VERSION_COL}=") and status.isDirectory() and (
                not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))):
            version, _, batch = name.partition("=")[2].partition(".")
            out.append((int(version), batch, name))
    return out


def current_version(spark, root: str) -> int | None:
    """Newest committed version under ``root``."""
    return max((v for v, _, _ in _versions(spark, root)), default=None)


def next_version(spark, root: str) -> int:
    """A number above every version under ``root``, those of lost writes included."""
    return max((v for v, _, _ in _versions(spark, root, committed=False)), default=0) + 1


def committed_batches(spark, root: str, stream: str) -> int:
    """How many batches of a stream the ledger has committed: they are numbered from 0, in order."""
    return max((int(b.rpartition("-")[2]) + 1 for _, b, _ in _versions(spark, root)
                if b.rpartition("-")[0] == stream), default=0)


def read_current(spark, root: str, schema=None) -> DataFrame | None:
    """The current ledger: the newest version folder, read on its own."""
    newest = max(_versions(spark, root), default=None)
    if newest is None:
        return None
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(f"{root}/{newest[2]}")
