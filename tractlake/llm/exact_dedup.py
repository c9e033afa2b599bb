"""Exact dedup: stateful streaming deduplication with a full check of the bytes.

The rows arrive as a stream of files. Its state is a table keyed by the digest of
the text, kept on disk (RocksDB) and never expired, so that a text is recognised
however much later its copy arrives. For each digest it retains

* the stable identifier of the row that stays (the largest key so far),
* the locator of that row's content (file and row number in the file),
* how many rows had the digest.

A digest that was hit more than once proves nothing yet: the bytes of each such
row are compared with those the locator names. Rows whose bytes differ under one
digest are grouped again by their whole text, so the result is exact with any
digest. Everything is DataFrame operations; no code runs in Python.

Hot groups: the state is aggregated before the shuffle; the join of rows to the
state is a plain equi-join that adaptive execution can split; the comparison of
bytes deals each group out over one salt per ``SALT_ROWS`` of its rows.

Defined cases: a null text counts as empty (so null and empty are equal); a null
key is smaller than any other; of rows with equal text and equal key, the one with
the largest locator stays; an empty table gives an empty result; columns besides
key and text are neither read nor able to clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tractlake.llm.common import written
from tractlake.session import scratch_dir

SALT_ROWS = 2048
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Disk-backed state with a bound on what all its instances in an executor hold in memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores would otherwise reserve more disk than they use.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(df: DataFrame, key: str, text: str, digest: Callable[[Column], Column],
          *others: Column) -> DataFrame:
    meta = df.metadataColumn("_metadata")
    return df.select(digest(F.coalesce(df[text], F.lit(""))).alias("digest"),
                     F.struct(df[key].alias("key"), meta.getField("file_path").alias("file"),
                              meta.getField("row_index").alias("row")).alias("id"), *others)


def update_state(spark: SparkSession, path: str, checkpoint: str, *, key: str = "doc_id",
                 text: str = "text", digest: Callable[[Column], Column] = sha256,
                 max_bytes: int = 1 << 40, max_files: int | None = None) -> DataFrame:
    """Feed the files below ``path`` that ``checkpoint`` hasn't seen yet into the state.

    A micro-batch takes ``max_bytes`` of input, or ``max_files`` files where that is
    given. Returns the state: digest, the row that stays (``top``: key, file, row), ``n``.
    A stopped run resumes at its checkpoint; later files find the earlier digests.
    """
    schema = spark.read.parquet(path).schema
    # A pattern, since a stream of files takes a single file only by a pattern.
    source = spark.readStream.schema(schema)
    source = (source.option("maxFilesPerTrigger", max_files) if max_files
              else source.option("maxBytesPerTrigger", max_bytes))
    clean = path.rstrip("/")
    stream = _rows(source.parquet(f"{clean[:-1]}[{clean[-1]}]"), key, text, digest)
    state = stream.groupBy("digest").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).start().awaitTermination())
        stored = spark.read.format("statestore").load(checkpoint)
        return written(stored.select(F.col("key.digest").alias("digest"),
                                     F.col("value.max").alias("top"),
                                     F.col("value.count").alias("n")), "digest-state")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def decide(spark: SparkSession, path: str, state: DataFrame, *, key: str = "doc_id",
           text: str = "text", digest: Callable[[Column], Column] = sha256,
           columns: list[str] | None = None) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept, and struct rest with
    ``columns``, which a row that doesn't stay may lack."""
    df = spark.read.parquet(path)
    names = list(dict.fromkeys([*(columns or []), text]))
    rows = _rows(df, key, text, digest, F.struct(*[df[f"`{c}`"] for c in names]).alias("rest"))
    body = F.coalesce(F.col(f"rest.`{text}`"), F.lit(""))
    joined = rows.join(state, "digest")
    if not columns:  # then the text goes on only where a digest was hit
        joined = joined.withColumn("rest", F.when(F.col("n") > 1, F.col("rest")))
    placed = written(joined, "dedup-rows")
    single = placed.filter("n = 1").select(
        "id", "digest", F.col("top.key").alias("keep_id"), F.col("n").alias("group_size"),
        F.lit(True).alias("kept"), "rest")
    hits = placed.filter("n > 1")
    last = F.floor((F.col("n") - 1) / SALT_ROWS).cast("int")
    stays = (hits.filter("id = top").select("digest", body.cast("binary").alias("bytes"),
                                            F.explode(F.sequence(F.lit(0), last)).alias("salt")))
    members = hits.withColumn("salt", F.pmod(F.xxhash64("id"), last + 1).cast("int"))
    other = F.when(body.cast("binary") != F.col("bytes"), body)
    # Only a row that may stay still needs its columns.
    checked = written(
        members.join(stays, ["digest", "salt"], "left").select(
            "id", "digest", "top", "n", "salt", other.alias("other"),
            F.when(other.isNotNull() | (F.col("id") == F.col("top")), F.col("rest")).alias("rest")), "dedup-checked")
    others = (checked.filter("other is not null").groupBy("digest", "other")
              .agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")))
    gone = (checked.filter("other is not null").groupBy("digest")
            .agg(F.count(F.lit(1)).alias("gone"), F.first(last).alias("last"))
            .select("digest", "gone", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("salt")))
    equal = (checked.filter("other is null").join(gone, ["digest", "salt"], "left")
             .select("id", "digest", F.col("top.key").alias("keep_id"),
                     (F.col("n") - F.coalesce("gone", F.lit(0))).alias("group_size"),
                     (F.col("id") == F.col("top")).alias("kept"), "rest"))
    differ = (checked.filter("other is not null").drop("top", "n").join(others, ["digest", "other"])
              .select("id", "digest", F.col("top.key").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("id") == F.col("top")).alias("kept"), "rest"))
    return single.unionByName(equal).unionByName(differ)


def dedup_files(spark: SparkSession, path: str, *, columns: list[str] | None = None,
                **options) -> DataFrame:
    """Both steps over the Parquet files below ``path``; see ``decide`` for the columns."""
    names = {k: options[k] for k in ("key", "text", "digest") if k in options}
    state = update_state(spark, path, scratch_dir(spark, "dedup-stream"), **options)
    return decide(spark, path, state, columns=columns, **names)


def dedup_frame(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. The frame lands as files first:
    they are what the stream reads and what the locators point into."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "dedup-landing")
    docs.write.parquet(path)
    kept = dedup_files(spark, path, columns=docs.columns, **options).filter("kept")
    return kept.select(*[F.col(f"rest.`{c}`") for c in docs.columns])
