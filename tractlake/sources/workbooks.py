"""Spreadsheet workbooks (xlsx) as rows, one task per workbook.

An xlsx file is a zip of XML parts; the standard library reads it. Each row
comes out as (path, sheet, sheet_no, row_no, header, values) with the cell
texts as strings; ``stack_sheets`` then aligns the sheets by header name in
Spark. Old binary ``.xls`` files are not readable here.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.session import scratch_dir

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "p": "http://schemas.openxmlformats.org/package/2006/relationships"}

ROW_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("sheet", T.StringType()),
    T.StructField("sheet_no", T.IntegerType()), T.StructField("row_no", T.LongType()),
    T.StructField("header", T.ArrayType(T.StringType())),
    T.StructField("values", T.ArrayType(T.StringType())),
])

_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    letters = _REF.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _number_text(v: str) -> str:
    """A number as text: an integral literal as it is, 3.0 as 3."""
    try:
        f = float(v)
    except ValueError:
        return v
    if re.fullmatch(r"[+-]?\d+", v) or "e" in v.lower():
        return v
    return v.split(".")[0] if f.is_integer() else v


def _cell_value(c, shared):
    t = c.get("t")
    if t == "inlineStr":
        return "".join(x.text or "" for x in c.iter(f"{{{NS['m']}}}t"))
    v = c.find("m:v", NS)
    if v is None:
        return None
    val = v.text or ""
    if t == "s":
        return shared[int(val)]
    if t in (None, "n"):
        return _number_text(val)
    return val


def _sheet_rows(z, part, shared):
    """Rows of one sheet, parsed as a stream (one row element in memory)."""
    row_tag = f"{{{NS['m']}}}row"
    with z.open(part) as fh:
        for _, elem in ET.iterparse(fh, events=("end",)):
            if elem.tag != row_tag:
                continue
            cells = {}
            for c in elem.findall("m:c", NS):
                val = _cell_value(c, shared)
                if val is not None:
                    cells[_col_index(c.get("r"))] = val
            width = max(cells) + 1 if cells else 0
            yield [cells.get(i) for i in range(width)]
            elem.clear()


def _sheets(body: bytes):
    """Yield (sheet name, row iterator) for each sheet in workbook order."""
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in rels.findall("p:Relationship", NS)}
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        for sh in wb.find("m:sheets", NS).findall("m:sheet", NS):
            rid = sh.get(f"{{{NS['r']}}}id")
            part = target[rid].lstrip("/")
            part = part if part.startswith("xl/") else "xl/" + part
            yield sh.get("name"), _sheet_rows(z, part, shared)


def _batch(rows: list) -> pa.RecordBatch:
    texts = pa.list_(pa.string())
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), texts, texts]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=ROW_SCHEMA.fieldNames())


def _rows(batches, batch_rows: int = 1000):
    """Rows of every sheet, gathered across sheets and workbooks into Arrow
    batches of at most ``batch_rows`` (many small files make few batches).
    Of a batch of workbooks only the one at hand is copied."""
    out = []
    for files in batches:
        for path, body in zip(files["path"], files["content"]):
            path = path.as_py()
            for no, (sheet, rows) in enumerate(_sheets(body.as_py())):
                first = next(rows, None)
                if first is None:
                    continue
                header = [h if h is not None else f"Unnamed: {i}" for i, h in enumerate(first)]
                for i, r in enumerate(rows, 1):
                    # A row wider than the header keeps all its cells.
                    names = header + [f"Unnamed: {j}" for j in range(len(header), len(r))]
                    out.append((path, sheet, no, i, names, r + [None] * (len(names) - len(r))))
                    if len(out) >= batch_rows:
                        yield _batch(out)
                        out = []
    if out:
        yield _batch(out)


def read_workbook_rows(files: DataFrame) -> DataFrame:
    """Rows of every sheet of every workbook in ``files`` (path, content)."""
    return files.select("path", "content").mapInArrow(_rows, ROW_SCHEMA)


def stack_sheets(rows: DataFrame, names=None) -> DataFrame:
    """Sheets stacked by header name: missing columns NULL, first-seen order,
    then the ``path`` and ``sheet`` each row came from.

    ``names`` (the union of headers) is metadata; when omitted it is read
    from the distinct headers, which are few (one per sheet layout).
    """
    if names is None:
        heads = (rows.groupBy("header").agg(F.min(F.struct("path", "sheet_no")).alias("first"))
                 .orderBy("first").collect())
        names = []
        for h in heads:
            names += [n for n in h["header"] if n not in names]
    m = F.map_from_arrays("header", "values")
    return rows.select(*[F.element_at(m, F.lit(n)).alias(n) for n in names], "path", "sheet")


def read_templates(rows: DataFrame, pattern: str, skip: int = 6, keep=()) -> DataFrame:
    """Lookup rows (varid, seq, label, ordinal) from template workbooks.

    ``rows`` come from :func:`read_workbook_rows`. Only files whose path
    matches ``pattern`` (one group: the sequence number) are kept, and
    entries with an empty number are dropped. The header names from
    position ``skip`` on are the measure ids and the cells their labels; only
    the first sheet of a workbook counts (later ones hold margins); the
    unpivot walks the (header, values) arrays, so sheets of any width share
    one plan. Empty labels are dropped; a measure labelled on two rows keeps
    the label of the first row. Columns in ``keep`` (e.g. ``year``) are
    carried as part of the key.
    """
    keep = list(keep)
    digits = F.regexp_extract("path", pattern, 1)
    t = rows.filter((F.col("sheet_no") == 0) & F.col("path").rlike(pattern) & (digits != "")) \
        .withColumn("seq", digits.cast("int"))
    cells = t.select(*keep, "path", "seq", "row_no",
                     F.posexplode(F.arrays_zip("header", "values")).alias("pos", "cell"))
    cells = cells.filter((F.col("pos") >= skip) & F.col("cell.values").isNotNull())
    long = cells.select(*keep, "seq", F.struct("path", "row_no").alias("_at"),
                        F.col("cell.header").alias("varid"), F.col("cell.values").alias("label"),
                        (F.col("pos") - skip + 1).cast("int").alias("ordinal"))
    first = long.groupBy(*keep, "seq", "varid", "ordinal").agg(
        F.min_by("label", "_at").alias("label"))
    return first.select(*keep, "varid", "seq", "label", "ordinal")


def land_workbook_rows(files: DataFrame) -> DataFrame:
    """The rows of :func:`read_workbook_rows`, parsed once and kept in the
    shared folder, so that looking for the headers first parses nothing again."""
    spark = files.sparkSession
    path = scratch_dir(spark, "workbook-rows")
    read_workbook_rows(files).write.parquet(path)
    return spark.read.schema(ROW_SCHEMA).parquet(path)


def read_workbook_sheets(files: DataFrame, names=None) -> DataFrame:
    """All sheets of all workbooks stacked by header name (one task per
    workbook split), with the ``path`` and ``sheet`` of each row."""
    return stack_sheets(read_workbook_rows(files) if names else land_workbook_rows(files), names)
