"""Zip archives as a table: one row per member.

Input is the ``binaryFile`` shape (``path``, ``content``). Expansion runs in
``mapInPandas``: each task opens the archives of its partition one at a
time with the standard ``zipfile`` module and yields member rows in small
Arrow batches (bounded by member count and bytes), so archives spread over
the cluster by file split. ``binaryFile`` packs files into partitions of at
most ``spark.sql.files.maxPartitionBytes``, which bounds a task's input.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBER_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])


def _members(batches, keep_dirs: bool, flatten: bool, max_rows: int = 64,
             max_bytes: int = 64 << 20):
    """Member rows, gathered across archives and flushed every ``max_rows``
    members or ``max_bytes`` of content, whichever comes first, so one output
    batch stays bounded and many small archives make few batches."""
    cols = MEMBER_SCHEMA.fieldNames()
    rows, size = [], 0
    for pdf in batches:
        for archive, body in zip(pdf["path"], pdf["content"]):
            folder = archive.rsplit("/", 1)[0] + "/" if "/" in archive else ""
            with zipfile.ZipFile(io.BytesIO(body)) as z:
                for info in z.infolist():
                    is_dir = info.filename.endswith("/")
                    if is_dir and not keep_dirs:
                        continue
                    name = info.filename
                    if flatten and not is_dir:
                        name = name.split("/")[-1]
                    data = b"" if is_dir else z.read(info)
                    rows.append((archive, info.filename, folder + name, data))
                    size += len(data)
                    if len(rows) >= max_rows or size >= max_bytes:
                        yield pd.DataFrame(rows, columns=cols)
                        rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=cols)


def expand_archives(files: DataFrame, keep_dirs: bool = True, flatten: bool = False) -> DataFrame:
    """(archive, member, path, content) for every member of every zip.

    ``keep_dirs=True, flatten=False``: every entry, its path = archive
    folder + member name (variant that lands a sequence archive).
    ``keep_dirs=False, flatten=True``: directory entries dropped, members
    keep only their base name (variant that lands the template archive).
    An empty archive yields no rows.
    """
    src = files.select("path", "content")
    return src.mapInPandas(lambda it: _members(it, keep_dirs, flatten), MEMBER_SCHEMA)


CHUNK_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def _opened(path: str, body):
    """A seekable file over the archive: its bytes, or the file at ``path``,
    of which only what is read is fetched."""
    if body is not None:
        return io.BytesIO(body)
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _chunks(batches, chunk_bytes: int, keep_empty: bool):
    cols = CHUNK_SCHEMA.fieldNames()
    for pdf in batches:
        bodies = pdf["content"] if "content" in pdf else [None] * len(pdf)
        rows, size = [], 0
        for archive, body in zip(pdf["path"], bodies):
            with _opened(archive, body) as raw, zipfile.ZipFile(raw) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    with z.open(info) as f:
                        at = 0
                        while (data := f.read(chunk_bytes)) or keep_empty and not at:
                            rows.append((archive, info.filename, at, data))
                            at, size = at + len(data), size + len(data)
                            if size >= chunk_bytes or len(rows) >= 1000:
                                yield pd.DataFrame(rows, columns=cols)
                                rows, size = [], 0
                            if not data:
                                break
        if rows:
            yield pd.DataFrame(rows, columns=cols)


def expand_chunks(files: DataFrame, chunk_bytes: int = 8 << 20, keep_empty: bool = False) -> DataFrame:
    """(archive, member, offset, content): members of any size, in pieces.

    A task holds one piece of at most ``chunk_bytes``, never a member. With
    ``content`` in ``files`` the archive's bytes come from there; without it
    (only ``path``) the archive is opened in place and read piece by piece,
    so it may be larger than a ``binaryFile`` row can be. An empty member has
    no piece, or with ``keep_empty`` an empty one; directory entries are dropped.
    """
    src = files.select("path", *(["content"] if "content" in files.columns else []))
    return src.mapInPandas(lambda it: _chunks(it, chunk_bytes, keep_empty), CHUNK_SCHEMA)


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip", **kw) -> DataFrame:
    """Expand every zip under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return expand_archives(files, **kw)


PACK_SCHEMA = T.StructType([T.StructField("path", T.StringType()),
                            T.StructField("content", T.BinaryType())])


def _pack(batches, folder: str, name_col: str, body_col: str, key_col: str, per_zip: int):
    """An archive per run of ``per_zip`` rows of a batch; only the member at hand is a Python object."""
    for batch in batches:
        for start in range(0, batch.num_rows, per_zip):
            chunk = batch.slice(start, per_zip)
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("pages/", b"")
                for name, body in zip(chunk[name_col], chunk[body_col]):
                    body = body.as_py()
                    z.writestr(f"pages/{name.as_py()}",
                               body if isinstance(body, bytes) else str(body).encode())
            key = pc.min(chunk[key_col]).as_py()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/archive-{key}.zip"], "content": [buf.getvalue()]})


def pack_archives(df: DataFrame, folder: str, name_col: str, body_col: str,
                  key_col: str, per_zip: int = 200) -> DataFrame:
    """Zip rows into archives of at most ``per_zip`` members (path, content).

    Each archive holds one folder entry and one member per row.
    """
    return df.select(name_col, body_col, key_col).mapInArrow(
        lambda it: _pack(it, folder, name_col, body_col, key_col, per_zip), PACK_SCHEMA)
