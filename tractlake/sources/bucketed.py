"""Tables bucketed and sorted by join keys, for joins that shuffle nothing.

Areas and sequences that are loaded once and joined many times are written with
the same keys and the same number of buckets. Each bucket is one file, written
by the task that holds it, so a join or group-by on the keys reads bucket by
bucket, without an exchange. Spark still puts a sort below a merge join; it
meets rows that are in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.operators.facts import JOIN_KEYS, region_key


def write_bucketed(df: DataFrame, table: str, buckets: int, keys=JOIN_KEYS, path: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` buckets; its files go to ``path`` if one is given.

    Choose the number so that a bucket of the largest table fits a task
    (a few hundred MB); all tables that are joined need the same one. The
    repartition uses the buckets' own hash, so every bucket is one sorted file.
    """
    keys = list(keys)
    w = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *keys).sortBy(*keys))
    (w.option("path", path) if path else w).saveAsTable(table)
    return df.sparkSession.table(table)


def keyed_areas(areas: DataFrame) -> DataFrame:
    """Areas with the region key as a stored column: (year, geoid, stusab_key, logrecno)."""
    return areas.select(F.col("year").cast("int").alias("year"), "geoid", region_key().alias("stusab_key"), "logrecno")


def keyed_sequence(seq: DataFrame) -> DataFrame:
    """A wide sequence with the region key in place of the region code."""
    return seq.withColumn("stusab_key", region_key("stusab")).drop("stusab").withColumn("year", F.col("year").cast("int"))


def load_bucketed(spark: SparkSession, areas: DataFrame, sequences: dict, name: str, buckets: int,
                  root: str | None = None) -> tuple:
    """(areas, {seq: frame}) read from bucketed tables ``{name}_areas`` and ``{name}_seq_{n}``."""
    def at(t):
        return f"{root}/{t}" if root else None
    out = write_bucketed(keyed_areas(areas), f"{name}_areas", buckets, path=at("areas"))
    seqs = {s: write_bucketed(keyed_sequence(df), f"{name}_seq_{s}", buckets, path=at(f"seq_{s}"))
            for s, df in sequences.items()}
    return out, seqs
