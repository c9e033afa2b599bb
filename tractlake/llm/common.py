"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tractlake.session import scratch_dir

# The white space that separates words, as a Java/RE2 class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; empty for null and for text without a word."""
    t = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(t != "", F.split(t, SPACE_CLASS + "+")).otherwise(F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body`` with ``value`` bound to a lambda variable, so that it is evaluated once a row."""
    return F.transform(F.array(value), body)[0]


def small_batches(spark: SparkSession, size: str = "8m"):
    """While it lasts, rows go to Python in batches of at most ``size`` (the session's own
    setting allows batches that, with what is computed from them, fill a small executor)."""
    @contextlib.contextmanager
    def held():
        name = "spark.sql.execution.arrow.maxBytesPerBatch"
        before = spark.conf.get(name)
        spark.conf.set(name, size)
        try:
            yield
        finally:
            spark.conf.set(name, before)
    return held()


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written to a table in the shared folder and read from there.

    Cuts lineage: a lost executor costs the tasks it ran, not what came before.
    ``files`` bounds the number of files of a table that is small at any scale.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with idx, its rows' places from 0 within their group, in order; nulls first.

    No group is brought together: rows are dealt by ranges of (group, order) and sorted; the
    table of the sorted rows has each row's place in its file. A group's first place in each
    range and the sizes of its earlier ranges (a row a group and range) give the rest. Rows
    that are equal in all of these columns are numbered in any order. No column of ``group``
    may be null.
    """
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(dealt.select("*", F.spark_partition_id().alias("_part"),
                                F.monotonically_increasing_id().alias("_at")), name)
    ranges = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    placed = rows.join(ranges, [*group, "_part"])
    return placed.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_part", "_at", "_first", "_rows", "_before")


def runs(batches, n_keys: int):
    """(key, table) of the runs of rows that agree in the first ``n_keys`` columns of sorted
    Arrow batches; a run may span batches."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    held, last = [], None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n - 1, bool)
        for c in batch.columns[:n_keys]:
            new |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a].as_py() for c in batch.columns[:n_keys])
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)
