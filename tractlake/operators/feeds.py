"""Feed files: drifting unions, column cleaning, typed loads, TSV repair."""

from __future__ import annotations

import csv
import io
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.session import scratch_dir

# The four feed table layouts (name, type, max text length).
S = T.StringType()


def _dec(p, s):
    return T.DecimalType(p, s)


DIRECTORY = [
    ("entity", S, 16), ("gsid", S, 16), ("universalid", S, 16), ("ncescode", S, 16),
    ("stateid", S, 32), ("name", S, 128), ("description", S, 512),
    ("schoolsummary", S, 2048), ("levelcode", S, 16), ("level", S, 32), ("street", S, 128),
    ("city", S, 64), ("state", S, 2), ("zip", S, 16), ("phone", S, 32), ("fax", S, 32),
    ("county", S, 64), ("fipscounty", S, 5), ("lat", _dec(10, 6), None),
    ("lon", _dec(10, 6), None), ("website", S, 1024), ("subtype", S, 1024),
    ("overviewurl", S, 1024), ("parentreviewsurl", S, 1024), ("testscoresurl", S, 512),
    ("type", S, 16), ("districtid", S, 16), ("universaldistrictid", S, 16),
    ("districtname", S, 512), ("districtspending", S, 16),
]
RATINGS = [("testratingid", S, 10), ("universalid", S, 10), ("rating", _dec(2, 0), None),
           ("url", S, 512)]
CITY_RATINGS = [("id", S, 10), ("name", S, 128), ("state", S, 2), ("rating", _dec(2, 0), None),
                ("url", S, 512), ("lat", _dec(10, 6), None), ("lon", _dec(10, 6), None),
                ("active", _dec(1, 0), None)]
DICTIONARY = [("id", S, 10), ("year", _dec(4, 0), None), ("description", S, 1024)]
FEED_LAYOUTS = {"directory": DIRECTORY, "ratings": RATINGS, "city_ratings": CITY_RATINGS,
                "dictionary": DICTIONARY}


def layout_schema(layout) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t, _ in layout])


def union_drift(frames) -> DataFrame:
    """Stack frames by column name; missing columns are NULL; first-seen
    column order; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_columns(df: DataFrame, drop: str = "-") -> DataFrame:
    """Remove ``drop`` from every column name."""
    return df.toDF(*[c.replace(drop, "") for c in df.columns])


def check_widths(df: DataFrame, layout) -> DataFrame:
    """Fail the job when a text value is longer than its declared length.

    The check is a filter that raises, evaluated while the rows stream
    through the write; it costs no extra pass.
    """
    bad = None
    for name, _, width in layout:
        if width is None:
            continue
        c = F.length(F.col(name)) > width
        bad = c if bad is None else (bad | c)
    if bad is None:
        return df
    return df.filter(F.when(F.coalesce(bad, F.lit(False)),
                            F.raise_error(F.lit("value longer than its column allows")))
                     .otherwise(F.lit(True)))


def typed_load(df: DataFrame, layout, by_position: bool = True) -> DataFrame:
    """All-text feed rows → typed table, as a positional load.

    Columns are matched by position (``by_position``) or name. Numbers are
    cast under ANSI rules, so text in a number column, or a number that does
    not fit its precision, fails the job. An empty field is NULL; a blank
    number is NULL too, while blank text stays as it is.
    """
    src = df.columns
    cols = []
    for i, (name, typ, _) in enumerate(layout):
        c = F.col(f"`{src[i]}`") if by_position else F.col(name)
        empty = (c == "") if isinstance(typ, T.StringType) else (F.trim(c) == "")
        c = F.when(empty, F.lit(None)).otherwise(c)
        cols.append(c.cast(typ).alias(name))
    return check_widths(df.select(*cols), layout)


def read_tsv_repaired(lines: DataFrame, columns, file_col: str = "file",
                      text_col: str = "value", bad: str = "\t \t",
                      good: str = "\t", salt_buckets: int = 16) -> DataFrame:
    """Split tab-separated lines into text columns, repairing bad files.

    A file whose widest line has more fields than ``columns`` would not
    parse; in such a file every ``bad`` sequence becomes ``good`` before
    splitting. Files that parse are left alone, even when they contain
    ``bad`` legitimately. A line that is still too wide after the repair
    fails the job. The per-file width is a grouped max (partial aggregation,
    one row per file) joined back on the file name with a salted join, so a
    single file holding most of the lines is still split over many tasks.
    """
    from tractlake.operators.skew import salted_lookup_join
    n = len(columns)
    width = F.size(F.split(F.col(text_col), "\t", -1))
    stats = lines.groupBy(file_col).agg(F.max(width).alias("_w"))
    j = salted_lookup_join(lines, stats, [file_col], salt_buckets)
    fixed = F.when(F.col("_w") > n, F.replace(F.col(text_col), F.lit(bad), F.lit(good))) \
        .otherwise(F.col(text_col))
    parts = j.select(F.col(file_col), F.split(fixed, "\t", -1).alias("_p"))
    parts = parts.filter(F.when(F.size("_p") > n, F.raise_error(
        F.lit("line has more fields than the header after repair"))).otherwise(F.lit(True)))
    return parts.select(F.col(file_col), *[F.try_element_at("_p", F.lit(i + 1)).alias(c)
                                           for i, c in enumerate(columns)])


def scan_by_date(df: DataFrame, ts: str, after: str) -> DataFrame:
    """Rows whose timestamp's date is later than ``after``.

    Written as ``ts >= after + 1 day`` so the predicate stays on the stored
    column and reaches the parquet scan as a pushed filter.
    """
    from tractlake.functions.columns import date_after
    return df.filter(date_after(ts, after))


def _member_rows(text: str, columns, header: bool, bad: str, good: str, rename=None):
    """Rows of one member, aligned to ``columns``: its own header decides where
    each column stands; a member whose widest row has more fields than its
    header is repaired (every ``bad`` becomes ``good``) and read again."""
    def rows():
        return (r for r in csv.reader(io.StringIO(text, newline=""), delimiter="\t") if r)
    first = next(rows(), None)
    if first is None:
        return
    names = [h.strip().replace("-", "") for h in first] if header else list(columns)
    names = [(rename or {}).get(n, n) for n in names]
    unknown = sorted(set(names) - set(columns))
    if unknown or len(set(names)) < len(names):
        raise ValueError(f"header with unknown or repeated names: {', '.join(unknown or names)}")
    if max(map(len, rows())) > len(names):
        text = text.replace(bad, good)
        if max(map(len, rows())) > len(names):
            raise ValueError("line has more fields than the header after repair")
    at = [names.index(c) if c in names else None for c in columns]
    for i, r in enumerate(rows()):
        if i or not header:
            yield [r[j] if j is not None and j < len(r) else None for j in at]


def _feed_reader(columns, header: bool, bad: str, good: str, rename=None, batch_rows: int = 1000):
    def run(batches):
        csv.field_size_limit(1 << 30)
        out = []
        for pdf in batches:
            for path, body in zip(pdf["path"], pdf["content"]):
                for r in _member_rows(bytes(body).decode("utf-8-sig"), columns, header, bad, good, rename):
                    out.append([path, *r])
                    if len(out) >= batch_rows:
                        yield pd.DataFrame(out, columns=["file", *columns])
                        out = []
        if out:
            yield pd.DataFrame(out, columns=["file", *columns])
    return run


def read_feed_archives(members: DataFrame, layout, header: bool = True, bad: str = "\t \t",
                       good: str = "\t", rename: dict | None = None) -> DataFrame:
    """Feed zips (already expanded) → repaired, typed feed table, in one pass without files.

    Each member is read by its own header (names without ``-``): columns may
    come in any order, missing ones are NULL, unknown ones fail the job unless
    ``rename`` maps them to a column of the layout.
    Fields may be quoted, and a quoted field may hold tabs and line breaks.
    Whether a member needs the repair is decided by that member alone, so
    nothing is shuffled. Without ``header`` columns go by position. For many
    or large members use :func:`read_feed_members`, which parses in the JVM.
    """
    names = [n for n, _, _ in layout]
    schema = T.StructType([T.StructField(c, S) for c in ["file", *names]])
    rows = members.select("path", "content").mapInPandas(_feed_reader(names, header, bad, good, rename), schema)
    return typed_load(rows, layout, by_position=False)


def _column_order(heads, columns, rename, by_position: bool):
    """Places (from 1) in the layout of a member's headings, as text; unknown or repeated ones fail."""
    known = F.array(*[F.lit(c) for c in columns])
    pairs = [x for old, new in (rename or {}).items() for x in (F.lit(old), F.lit(new))]
    if pairs:
        mapped = F.create_map(*pairs)
        heads = F.transform(heads, lambda h: F.coalesce(F.try_element_at(mapped, h), h))
    place = F.transform(heads, lambda h: F.array_position(known, h))
    unknown = F.filter(heads, lambda h: ~F.array_contains(known, h))
    order = F.when(
        (F.size(unknown) > 0) | (F.size(F.array_distinct(heads)) < F.size(heads)),
        F.raise_error(F.concat(F.lit("header with unknown or repeated names: "), F.array_join(
            F.when(F.size(unknown) > 0, F.array_sort(unknown)).otherwise(heads), ", ")))).otherwise(place)
    if by_position:
        there = F.array(*[F.lit(i).cast("bigint") for i in range(1, len(columns) + 1)])
        in_place = F.forall(F.zip_with(place, there, lambda p, i: (p == 0) | (p == i)), lambda x: x)
        order = F.when((F.size(heads) == len(columns)) & in_place, there).otherwise(order)
    return F.array_join(F.transform(order, lambda p: p.cast("string")), ".")


def _field_count(record):
    """Fields of a raw tab-separated record; tabs inside quoted fields don't count."""
    bare = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), r'(^|\t)"[^"]*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit("\t"), F.lit(""))) + 1


def _parsed(spark, root: str, orders) -> DataFrame:
    """(member, order, cells, width) of the landed bodies, by Spark's own multi-line reader."""
    out = None
    for order in orders:  # a read for each column order: few, and each has its width
        n = order.count(".") + 1
        schema = T.StructType([T.StructField(f"c{i}", S) for i in range(n)] + [T.StructField("_bad", S)])
        rows = (spark.read.schema(schema.add("member", S)).option("sep", "\t").option("quote", '"').option("escape", '"')
                .option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
                .csv(f"{root}/order={order}"))
        rows = rows.select("member", F.lit(order).alias("order"), F.array(*[f"c{i}" for i in range(n)]).alias("cells"),
                           F.when(F.col("_bad").isNull(), n).otherwise(_field_count(F.col("_bad"))).alias("width"))
        out = rows if out is None else out.unionByName(rows)
    return out


def read_feed_members(members: DataFrame, layout, header: bool = True, bad: str = "\t \t", good: str = "\t",
                      rename: dict | None = None, by_position: bool = False) -> DataFrame:
    """Feed zips (already expanded) → repaired, typed feed table, without a Python parser.

    Every member's body lands as a file of its own, in a folder that names
    the member's column order (from its header), and Spark's multi-line CSV reader
    parses it: fields may be quoted and hold tabs and line breaks. An aggregate
    over each member's rows finds those with more fields than their header;
    in such a member every ``bad`` becomes ``good``, and it is parsed once
    more. A row that is still too wide fails the job.

    Columns may come in any order, missing ones are NULL, short rows are
    filled with NULL. Unknown or repeated headings fail, unless ``rename`` maps them or,
    with ``by_position``, all headings are as many as the layout's and the
    known ones stand in their place: then columns go by position, as a
    positional load of the file would.
    """
    spark = members.sparkSession
    names = [n for n, _, _ in layout]
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff?[\r\n]*", "")
    head = F.regexp_extract(text, r"^[^\r\n]*", 0)
    heads = F.transform(F.split(head, "\t", -1), lambda h: F.replace(
        F.btrim(F.regexp_replace(h, r'^\s*"(.*)"\s*$', "$1")), F.lit("-"), F.lit("")))
    everything = ".".join(str(i + 1) for i in range(len(names)))
    rows = members.select(
        F.sha1(F.concat(F.col("path").cast("binary"), F.lit(b"\0"), "content")).alias("member"),
        (_column_order(heads, names, rename, by_position) if header else F.lit(everything)).alias("order"),
        (F.regexp_replace(F.substr(text, F.length(head) + 1), r"^\r?\n?", "") if header else text).alias("body"),
        text.alias("_text")).filter(F.col("_text") != "").drop("_text")

    def stored(df, name):
        folder = scratch_dir(spark, name)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)
    rows = stored(rows, "feed-members")  # archives are opened once
    orders = [r["order"] for r in rows.select("order").distinct().collect()]  # headings, not data
    if not orders:
        empty = spark.createDataFrame([], T.StructType([T.StructField(c, S) for c in names]))
        return typed_load(empty, layout, by_position=False)

    def landed(df, name):
        folder = scratch_dir(spark, name)
        df.select("body", "order", "member").write.partitionBy("order", "member").text(folder)
        return folder
    # Stored, so that the widths are those of whole rows and every file is parsed once.
    first = stored(_parsed(spark, landed(rows, "feed-bodies"), orders), "feed-rows")
    wide = (first.groupBy("member", "order").agg(F.max("width").alias("w"))
            .filter(F.col("w") > F.size(F.split("order", r"\."))).select("member"))
    wide = stored(wide, "feed-wide")
    cells = first.join(wide, "member", "left_anti")
    again = [r["order"] for r in rows.join(wide, "member", "left_semi").select("order").distinct().collect()]
    if again:
        mended = rows.join(wide, "member", "left_semi").withColumn("body", F.replace("body", F.lit(bad), F.lit(good)))
        second = stored(_parsed(spark, landed(mended, "feed-mended"), again), "feed-mended-rows")
        cells = cells.unionByName(second.filter(F.when(
            F.col("width") > F.size(F.split("order", r"\.")),
            F.raise_error(F.lit("line has more fields than the header after repair"))).otherwise(F.lit(True))))
    places = F.split("order", r"\.")
    return typed_load(cells.select(*[
        F.when(F.array_contains(places, str(i)), F.get("cells", (F.array_position(places, str(i)) - 1).cast("int"))).alias(c)
        for i, c in enumerate(names, 1)]), layout, by_position=False)
