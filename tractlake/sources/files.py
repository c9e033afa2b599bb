"""Text file sources and sinks: sequences, positional CSV, catalog, yearly
folders, staged CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("group_name", T.StringType()), T.StructField("metric_name", T.StringType()),
    T.StructField("formula", T.StringType()), T.StructField("statistic", T.StringType()),
    T.StructField("start_year", T.IntegerType()), T.StructField("end_year", T.IntegerType()),
    T.StructField("notes", T.StringType()),
])

SEQUENCE_NULL = "."


def read_positional(spark: SparkSession, paths, schema: T.StructType, header: bool = True,
                    null_value: str = "", sep: str = ",") -> DataFrame:
    """Comma file(s) loaded by column position into a typed schema.

    ``FAILFAST``: a short row or a value that does not parse fails the job.
    Spark parses only the columns a query needs, so materialise every column
    (write the result) to check the whole file; see :func:`load_table`.
    """
    return (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
            .option("enforceSchema", True).option("nullValue", null_value)
            .option("sep", sep).csv(paths))


def read_sequence(spark: SparkSession, paths, schema: T.StructType,
                  null_value: str = SEQUENCE_NULL, base_path: str | None = None) -> DataFrame:
    """Headerless sequence file(s): six text columns, then decimals.

    Rows of several regions stack into one table. Folders named
    ``year=NNNN`` below ``base_path`` add a ``year`` column.
    """
    r = (spark.read.schema(schema).option("header", False).option("mode", "FAILFAST")
         .option("nullValue", null_value))
    if base_path:
        r = r.option("basePath", base_path)
    return r.csv(paths)


def file_order(df: DataFrame, column: str = "ordinal") -> DataFrame:
    """``df``, just read from files, with each row's place from 0: by file name, then place in the file.

    A file may be read in several splits. Rows are numbered inside their
    split as they are read; the splits' sizes (a row a split) give each split's
    first number, joined back on (file, start of the split).
    """
    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                   F.monotonically_increasing_id().alias("_at"))
    splits = at.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    splits = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return (at.join(splits, ["_file", "_start"])
            .withColumn(column, F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_file", "_start", "_at", "_first", "_before"))


def read_catalog(spark: SparkSession, path) -> DataFrame:
    """Catalog CSV (header row, optional byte-order mark), by position.

    Names are trimmed; ``ordinal`` is a row's place over all files, in the
    order of their names.
    """
    df = (spark.read.schema(CATALOG_SCHEMA).option("header", True).option("mode", "FAILFAST")
          .option("enforceSchema", True).option("encoding", "UTF-8").csv(path))
    return file_order(df).withColumns({"group_name": F.trim("group_name"), "metric_name": F.trim("metric_name")})


def write_staged_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def load_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Write every column to parquet (this is where FAILFAST loads fail)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_yearly(spark: SparkSession, years, path_for, fmt: str = "parquet",
                year_pattern: str = r"(\d{4})", **options) -> DataFrame:
    """The same dataset over an irregular list of years, year tagged.

    ``path_for(year)`` gives each year's path (the first year may differ).
    One read over all paths; the year comes from each row's file path.
    """
    paths = [path_for(y) for y in years]
    df = spark.read.format(fmt).options(**options).load(paths)
    yr = F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).cast("int")
    return df.withColumn("year", yr)


def scan_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Whole-table read: a catalog table name, or a folder of files."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)
