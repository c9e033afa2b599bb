"""A stored fact table that is updated by new versions of the years that change.

Layout below a root folder::

    data/v=<version>/of_year=<year>/…   the years that this version wrote
    versions/v=<version>/…              its manifest: year, folder, version

The manifest is written last and is the switch: a reader takes the newest
manifest that was finished, so a writer that is lost before that leaves the
old version in place, and what it wrote is never read. Years that an update
does not touch keep their files; the new manifest names them again. There is
one writer at a time; readers are never disturbed. Old versions stay until the
folder's retention rule removes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.operators import facts, ledger

MANIFEST = "year int, folder string, version bigint"


def _versions(root: str) -> str:
    return f"{root}/versions"


def manifest(spark: SparkSession, root: str) -> dict:
    """year → folder of the current version; empty before the first."""
    df = ledger.read_current(spark, _versions(root), MANIFEST)
    return {} if df is None else {r["year"]: r["folder"] for r in df.collect()}  # a row a year


def _commit(spark: SparkSession, root: str, version: int, folders: dict) -> None:
    rows = spark.createDataFrame([(y, f, version) for y, f in sorted(folders.items())], MANIFEST)
    ledger.write_snapshot(rows.coalesce(1), _versions(root), version)


def _write(df: DataFrame, root: str, version: int, years) -> dict:
    """The rows of ``years`` in a folder each; (year → folder)."""
    folder = f"{root}/data/v={version:012d}"
    rows = df.withColumn("of_year", F.col("year")).hint("rebalance", "of_year")
    rows.write.mode("overwrite").partitionBy("of_year").parquet(folder)
    return {y: f"{folder}/of_year={y}" for y in years}


def create(spark: SparkSession, root: str, fact: DataFrame) -> int:
    """The first version, or one that replaces all years. Returns its number."""
    version = ledger.next_version(spark, _versions(root))
    years = [r["year"] for r in fact.select("year").distinct().collect()]
    _commit(spark, root, version, _write(fact, root, version, years))
    return version


def read(spark: SparkSession, root: str, years=None) -> DataFrame:
    """The current fact table, or those of its ``years``. Columns that a later update
    added are NULL in years it did not touch."""
    folders = {y: f for y, f in manifest(spark, root).items() if years is None or y in set(years)}
    if not folders:
        raise ValueError(f"no stored fact rows below {root} for {'any year' if years is None else sorted(years)}")
    return spark.read.option("mergeSchema", "true").parquet(*[folders[y] for y in sorted(folders)])


def years_of(df: DataFrame) -> set:
    return {r["year"] for r in df.select(F.col("year").cast("int").alias("year")).distinct().collect()}


def add_years(spark: SparkSession, root: str, fact: DataFrame, years=None) -> dict:
    """The years of ``fact`` that are not stored yet, as a new version; stored ones stay as they are.

    ``years`` are those that ``fact`` has, where the caller knows them; else they are looked up."""
    folders = manifest(spark, root)
    years = sorted((years_of(fact) if years is None else set(years)) - set(folders))
    if not years:
        return {"version": ledger.current_version(spark, _versions(root)), "years": []}
    version = ledger.next_version(spark, _versions(root))
    new = _write(fact.filter(F.col("year").isin(years)), root, version, years)
    _commit(spark, root, version, {**folders, **new})
    return {"version": version, "years": years}


def upsert(spark: SparkSession, root: str, src: DataFrame, cols=None, rank: str | None = None, years=None) -> dict:
    """Overwrite the stored cells with ``src`` where it is not NULL, as a new version.

    Only the years of ``src`` that are stored are read and written; areas that
    are not stored are not added, as with an UPDATE. ``src`` must be unique
    on (year, geoid), or, with ``rank`` (the name of a column), on these and the rank: then the
    value of the highest rank wins, as with one upsert per rank. ``years`` are those that ``src``
    has; without them ``src`` is computed once more to find them. Returns the version and the
    touched years; nothing is written if no stored year is touched.
    """
    folders = manifest(spark, root)
    touched = sorted((years_of(src) if years is None else set(years)) & set(folders))
    if not touched:
        return {"version": ledger.current_version(spark, _versions(root)), "years": []}
    version = ledger.next_version(spark, _versions(root))
    new = src.filter(F.col("year").isin(touched))
    old = read(spark, root, touched)
    rows = facts.upsert_ranked(old, new, rank=rank) if rank else facts.upsert_fact(old, new, cols=cols)
    _commit(spark, root, version, {**folders, **_write(rows, root, version, touched)})
    return {"version": version, "years": touched}
