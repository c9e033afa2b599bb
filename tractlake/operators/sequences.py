"""Sequence files of all kinds, years and sequences as one long table.

A sequence file has six text columns and then one column per measure, in the
order of the year's lookup. Instead of a schema and a job per sequence, all
files are read as lines in one plan; the file's path says which kind, year and
sequence a line belongs to, the lookup says which measure stands at each
position, and every line becomes one row per measure.

The long table is stored by kind / year / seq. A sequence that a year does not
have is a folder that does not exist, so reading any range of years is a filter
on partition columns and absent sequences give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.operators.facts import FIXED_SEQ_COLUMNS
from tractlake.operators.listing import NATIONAL_CODE, TRACT_LEVEL, region_code_from_listing
from tractlake.operators.lookup import MEASURE_TYPE

# Fixed value: the survey's file names, {kind}{year}5{region}{sequence}000.txt.
FILE_NAME = r"/(?<kind>[em])(?<year>\d{4})5(?<region>[a-z]{2})(?<seq>\d{4})000\.txt$"
FILE_GLOB = "[em]*000.txt"
STORE_KEYS = ["kind", "year", "seq"]
NULL_TEXT = "."


def _group_of(pattern: str, name: str) -> int | None:
    """Number of a named group of a pattern (Java and Python spell them alike here)."""
    import re
    return re.compile(pattern.replace("(?<", "(?P<")).groupindex.get(name)


def file_identity(path: Column, pattern: str = FILE_NAME) -> dict:
    """kind, year and seq of a sequence file, and its region if the pattern names one."""
    out = {}
    for name, cast in (("kind", "string"), ("year", "int"), ("seq", "int"), ("region", "string")):
        g = _group_of(pattern, name)
        if g is not None:
            out[name] = F.regexp_extract(path, pattern, g).cast(cast)
    return out


def sequence_lines(spark: SparkSession, root: str, glob: str | None = FILE_GLOB,
                   pattern: str = FILE_NAME) -> DataFrame:
    """Lines of all sequence files below ``root``: path, kind, year, seq, value.

    One read; files whose path does not match are left out before their
    identity is cast, empty lines are skipped as the CSV reader does.
    """
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    lines = r.text(root).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = lines.filter(F.col("path").rlike(pattern) & (F.col("value") != ""))
    return lines.select("path", *[c.alias(n) for n, c in file_identity(F.col("path"), pattern).items()], "value")


def landed_files(spark: SparkSession, root: str, glob: str = FILE_GLOB, pattern: str = FILE_NAME) -> DataFrame:
    """path, kind, year and seq of the sequence files below ``root``; no file body is read."""
    paths = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root).select("path"))
    return paths.filter(F.col("path").rlike(pattern)).select(
        "path", *[c.alias(n) for n, c in file_identity(F.col("path"), pattern).items()])


def of_known_folders(lines: DataFrame, listing: DataFrame, years) -> DataFrame:
    """Lines whose file stands where the survey puts it.

    A folder's region code comes from its ``g{year}`` file; its sequence files
    carry that code, and the national folder has no tract-level files. The
    folders (regions times levels) are joined on (folder, year, code), which
    are functions of the path, so no path reaches the driver.
    """
    codes = None
    for y in years:
        c = region_code_from_listing(listing, y).select("folder", F.lit(int(y)).alias("year"),
                                                        F.col("region_code").alias("region"))
        codes = c if codes is None else codes.unionByName(c)
    level = F.regexp_extract("folder", r"([^/]*)$", 1)
    codes = codes.filter(~((level == TRACT_LEVEL) & (F.col("region") == NATIONAL_CODE)))
    return lines.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).join(
        codes, ["folder", "year", "region"], "left_semi").drop("folder")


def measure_order(lookup: DataFrame) -> DataFrame:
    """(year, seq, varids): a sequence's measures in column order, one row each.

    A measure listed twice in a sequence counts at its first place. Without a
    ``year`` column the order holds for all years. The list is bounded by the
    width of a file.
    """
    keys = [c for c in ("year", "seq") if c in lookup.columns]
    first = lookup.groupBy(*keys, "varid").agg(F.min("ordinal").alias("ordinal"))
    order = first.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("ordinal", "varid"))).alias("m"))
    return order.select(*[F.col(k).cast("int").alias(k) for k in keys], F.col("m.varid").alias("varids"))


def long_form(lines: DataFrame, lookup: DataFrame, sep: str = ",", null_text: str = NULL_TEXT) -> DataFrame:
    """One row per line and measure: kind, year, seq, the six columns, varid, value.

    Lines are joined to their sequence's measure list (one row per year and
    sequence) before they are taken apart, so the join moves lines, not cells.
    A line with another number of fields than the lookup says, or a value that
    is no number, fails the job. Lines of a sequence that the lookup of their
    year does not list are left out (see :func:`unlisted`).
    """
    order = measure_order(lookup)
    keys = [c for c in order.columns if c != "varids"]
    n = len(FIXED_SEQ_COLUMNS)
    # years times sequences, each as long as a file is wide: small, and the lines stay where they are
    rows = lines.withColumn("f", F.split("value", sep, -1)).join(F.broadcast(order), keys)
    rows = rows.filter(F.when(
        F.size("f") != n + F.size("varids"),
        F.raise_error(F.concat(F.lit("line with "), F.size("f").cast("string"), F.lit(" fields where the lookup has "),
                               (n + F.size("varids")).cast("string"), F.lit(": "), F.col("path")))
    ).otherwise(F.lit(True)))

    def text(c):
        return F.when((c != null_text) & (c != ""), c)
    rows = rows.select(*STORE_KEYS, *[text(F.col("f")[i]).alias(c) for i, c in enumerate(FIXED_SEQ_COLUMNS)],
                       "varids", "f")
    cells = rows.select(*STORE_KEYS, *FIXED_SEQ_COLUMNS, "f", F.posexplode("varids").alias("pos", "varid"))
    return cells.select(*STORE_KEYS, *FIXED_SEQ_COLUMNS, "varid",
                        text(F.get("f", F.col("pos") + n)).cast(MEASURE_TYPE).alias("value"))


def unlisted(landed: DataFrame, lookup: DataFrame) -> DataFrame:
    """(kind, year, seq) of landed files whose sequence the lookup does not list."""
    keys = [c for c in ("year", "seq") if c in lookup.columns]
    return landed.select(*STORE_KEYS).distinct().join(
        lookup.select(*[F.col(k).cast("int").alias(k) for k in keys]).distinct(), keys, "left_anti")


def together(rows: DataFrame) -> DataFrame:
    """Rows of a kind, year and sequence put together; many of them are split again, so that
    no sequence has to fit one task."""
    return rows.hint("rebalance", *STORE_KEYS)


def write_store(cells: DataFrame, out: str, mode: str = "overwrite", dealt: bool = False) -> None:
    """The long table, partitioned by kind / year / seq, in one write.

    A partition's rows are put together so that it gets few files; with ``dealt`` they
    already are. Do that with the lines, which are as many times fewer than the cells as a
    file is wide. With mode ``overwrite`` only the partitions that ``cells`` has are replaced.
    """
    ((cells if dealt else together(cells)).write.mode(mode).partitionBy(*STORE_KEYS)
     .option("partitionOverwriteMode", "dynamic").parquet(out))


STORE_SCHEMA = ", ".join([*[f"{c} string" for c in FIXED_SEQ_COLUMNS], "varid string",
                          f"value {MEASURE_TYPE.simpleString()}", "kind string", "year int", "seq int"])


def read_store(spark: SparkSession, out: str, kind: str | None = "e", years=None, seqs=None) -> DataFrame:
    """The long table; kind, years and seqs are filters on partition folders."""
    df = spark.read.schema(STORE_SCHEMA).parquet(out)
    if kind is not None:
        df = df.filter(F.col("kind") == kind)
    if years is not None:
        df = df.filter(F.col("year").isin([int(y) for y in years]))
    if seqs is not None:
        df = df.filter(F.col("seq").isin([int(s) for s in seqs]))
    return df


def wide_form(cells: DataFrame, measures, fixed: bool = False) -> DataFrame:
    """One row per (year, region, record) with a column per measure.

    The cells of a line stand next to each other, so the aggregate combines
    them before its shuffle: it moves one row per line, as a wide table
    would. A record with a measure twice fails the job. ``fixed`` keeps
    the other leading columns of the file.
    """
    keys = ["year", "stusab", "logrecno"]
    keep = [c for c in FIXED_SEQ_COLUMNS if c not in keys] if fixed else []
    here = [F.col("varid") == m for m in measures]
    agg = cells.filter(F.col("varid").isin(list(measures))).groupBy(*keys, *keep).agg(
        *[F.max(F.when(h, F.col("value"))).alias(m) for m, h in zip(measures, here)],
        F.greatest(*[F.count_if(h) for h in here], F.lit(0)).alias("_n"))
    checked = agg.filter(F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit("record with a measure twice: "), F.col("stusab"), F.lit(" "), F.col("logrecno"))))
        .otherwise(F.lit(True)))
    order = [c for c in FIXED_SEQ_COLUMNS if fixed or c in keys]
    return checked.select(*order, "year", *measures)


def stored_sequences(spark: SparkSession, out: str, lookup_rows, kind: str = "e", years=None) -> dict:
    """seq → wide frame of the stored years, for every sequence of the lookup.

    The frames are lazy and each reads its own folders only. Years whose
    folder is absent have no rows, also where no year has the sequence, so a
    plan over them gives NULL there.
    """
    ids: dict = {}
    for r in lookup_rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        ids.setdefault(int(r["seq"]), {}).setdefault(r["varid"], None)
    return {s: wide_form(read_store(spark, out, kind, years, [s]), list(ms)) for s, ms in sorted(ids.items())}


def paired(cells: DataFrame) -> DataFrame:
    """(year, seq, region, record, measure, estimate, margin) from both kinds of the long table.

    One aggregate over both kinds: a cell that only one of them has keeps its row.
    """
    side = {k: F.when(F.col("kind") == k, F.col("value")) for k in ("e", "m")}
    agg = cells.groupBy("year", "seq", "stusab", "logrecno", F.col("varid").alias("measure")).agg(
        F.max(side["e"]).alias("estimate"), F.max(side["m"]).alias("margin"),
        F.greatest(F.count_if(F.col("kind") == "e"), F.count_if(F.col("kind") == "m")).alias("_n"))
    checked = agg.filter(F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit("record with a measure twice: "), F.col("stusab"), F.lit(" "), F.col("logrecno"))))
        .otherwise(F.lit(True)))
    return checked.drop("_n")
