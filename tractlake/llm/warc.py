"""WARC archives: a writer, and a reader that salvages what a damaged archive still holds.

Writer. Each row becomes a record in a gzip member of its own; files roll at ``ROLL`` bytes.
Of rows with equal payloads (SHA-1 and length) of at least ``min_bytes``, the one with the
largest key is a ``response``; the others are ``revisit`` records that refer to it and hold
the HTTP head only. The largest key is aggregated before the shuffle; rows join it by an
equi-join, whose hot partitions adaptive execution can split.

Reader. A record is taken only if its checks hold: the member's CRC, the version line,
Content-Length and the closing blank lines, the block's and the payload's digest (base32 or hex,
of either case). Version lines of all versions count, and field lines may be folded. After a
failed check the reader looks for the next gzip member or version line from which a record
passes all checks, goes on there, and reports the bytes in between as a gap with the first
reason. It looks inside a member's content too, so one bad record doesn't cost the member's
others; records of a member that is cut off or fails its CRC are kept as ``salvaged``. Compressed and plain records may follow one another in a file. A file is read
whole, so a task needs memory for ``ROLL`` bytes (or one larger record).

Defined cases: a null payload is empty; a null key is written as ``null``, is smaller than
any other and reads back as null; of repeated rows with the largest key each is a response;
a null target is left out; an empty table gives no file and no record; columns besides the
three are neither read nor able to clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tractlake.llm.common import written
from tractlake.llm.files import new_file, whole_file
from tractlake.session import scratch_dir

ROLL = 1 << 25
URN = "urn:x-page:"
# Fixed values of the format.
GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
ALGORITHMS = {"sha1", "md5", "sha256", "sha512"}
DATE = "2000-01-01T00:00:00Z"  # the tables have no crawl time

MANIFEST = "file string, records bigint, bytes bigint"
ROWS = ("kind string, file string, start bigint, end bigint, reason string, record_type string, record_key string, "
        "target string, refers_to string, payload_digest string, payload_bytes bigint, payload binary")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- Writing -----------------------------------------------------------------------------

def record(key, target: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the payload's length, and no payload."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
             % len(payload)) + (b"" if revisit else payload)
    name = lambda k: f"<{URN}{'null' if k is None else k}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(key)}",
            f"WARC-Date: {DATE}"]
    if target is not None:
        head.append(f"WARC-Target-URI: {quote(target, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def roles(pages: DataFrame, *, key: str, target: str, payload: str, min_bytes: int) -> DataFrame:
    """key, target, payload, refers_to, revisit."""
    body = F.coalesce(pages[payload], F.lit("")).cast("binary")
    rows = pages.select(pages[key].alias("key"), pages[target].alias("target"), body.alias("payload"))
    rows = rows.withColumn("same", F.struct(F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n")))
    first = rows.groupBy("same").agg(F.max("key").alias("first"))
    revisit = (F.col("same.n") >= min_bytes) & ~F.col("key").eqNullSafe(F.col("first"))
    return rows.join(first, "same").select("key", "target", "payload", F.when(revisit, F.col("first")).alias("refers_to"),
                                           revisit.alias("revisit"))


def _writer(folder: str, roll: int):
    def run(batches):
        uri = out = None
        done = size = 0

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"file": [uri], "records": [done], "bytes": [size]})
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    (uri, out), done, size = new_file(folder, ".warc.gz"), 0, 0
                data = member(record(row["key"], row["target"], row["payload"], sha1_base32(row["payload"]),
                                     row["refers_to"], row["revisit"]))
                out.write(data)
                done, size = done + 1, size + len(data)
                if size >= roll:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_warc(pages: DataFrame, *, key: str = "page_id", target: str = "url", payload: str = "html",
               min_bytes: int = 0, folder: str | None = None, roll: int = ROLL) -> DataFrame:
    """The manifest of the archives written: file, records, bytes."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    rows = roles(pages, key=key, target=target, payload=payload, min_bytes=min_bytes)
    return written(rows.mapInArrow(_writer(folder, roll), MANIFEST), "warc-manifest")


# --- Reading -----------------------------------------------------------------------------

class Bad(Exception):
    """A check that failed."""


def _stated(digest: str | None) -> tuple[str, bytes] | None:
    """(algorithm, value) of a stated digest, in base32 or hex of either case; None for one of an
    algorithm that isn't known, or spelt in neither way: it can't be checked."""
    name, _, value = (digest or "").partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip().rstrip("=")
    if name not in ALGORITHMS:
        return None
    size = hashlib.new(name).digest_size
    try:
        if len(value) == 2 * size:
            return name, bytes.fromhex(value)
        if len(value) == -(-size * 8 // 5):
            return name, base64.b32decode(value + "=" * (-len(value) % 8), casefold=True)
    except ValueError:
        pass
    return None


def _digest_ok(stated: str | None, data: bytes) -> bool:
    known = _stated(stated)
    return known is None or hashlib.new(known[0], data).digest() == known[1]


def parse_record(data: bytes, at: int) -> tuple[int, dict, bytes]:
    """(end, fields, block) of the record at ``at``; raises Bad if a check fails."""
    if not VERSION.match(data, at):
        raise Bad("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise Bad("head without end")
    fields = {}
    last = None
    for line in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in " \t" and last:  # a folded line goes on with the field before it
            fields[last] = f"{fields[last]} {line.strip()}".strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("line without field")
        last = name.strip().lower()
        fields[last] = value.strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields or "warc-record-id" not in fields:
        raise Bad("mandatory field missing")
    start = head + 4
    end = start + int(fields["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise Bad("length doesn't end at blank lines")
    block = data[start:end]
    if not _digest_ok(fields.get("warc-block-digest"), block):
        raise Bad("block digest differs")
    if fields["warc-type"] == "response" and not _digest_ok(fields.get("warc-payload-digest"), http_body(block)):
        raise Bad("payload digest differs")
    return end + 4, fields, block


def http_body(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return body if head.startswith(b"HTTP/") else block


def inflate(data: bytes, at: int, step: int = 1 << 16) -> tuple[int | None, bytes, str | None]:
    """(end, content, reason) of the gzip member at ``at``. The reason (None: whole, CRC holds) says
    why the content is only what came out until then; the end is None if it isn't known."""
    z, parts, pos = zlib.decompressobj(31), [], at
    while not z.eof:
        if pos >= len(data):
            return len(data), b"".join(parts), "member cut off"
        chunk, before = data[pos:pos + step], z.copy()
        try:
            parts.append(z.decompress(chunk))
        except zlib.error as e:
            # Once more by bytes, for what comes out before the damage.
            for i in range(len(chunk)):
                try:
                    parts.append(before.decompress(chunk[i:i + 1]))
                except zlib.error:
                    break
            end = pos + i + (5 if "data check" in str(e) else 1) if " check" in str(e) else None
            return end and min(end, len(data)), b"".join(parts), f"member damaged ({str(e)[:40]})"
        pos += len(chunk)
    return pos - len(z.unused_data), b"".join(parts), None


def inner_records(inner: bytes) -> tuple[list[tuple[dict, bytes]], list[str]]:
    """(records, reasons with the bytes lost) of a member's content: after a failed check it goes
    on at the next version line from which a record passes."""
    found, gaps, pos, lost, why = [], [], 0, None, None
    while pos < len(inner):
        try:
            end, fields, block = parse_record(inner, pos)
        except Bad as e:
            lost, why = (pos, str(e)) if lost is None else (lost, why)
            m = VERSION.search(inner, pos + 1)
            pos = m.start() if m else len(inner)
            continue
        if lost is not None:
            gaps.append(f"{why} (bytes {lost} to {pos} of the member's content)")
            lost = None
        found.append((fields, block))
        pos = end
    if lost is not None:
        gaps.append(f"{why} (bytes {lost} to {pos} of the member's content)" if found else why)
    return found, gaps


def _candidate(data: bytes, at: int) -> int:
    """The next place from ``at`` on where a member or a version line may start."""
    member_, line = data.find(GZIP, at), VERSION.search(data, at)
    return min((p for p in (member_, line.start() if line else -1) if p >= 0), default=len(data))


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', start, end, fields, block) and ('gap', start, end, reason) in file order. A record
    with a digest that holds, from a member that is cut off or damaged, comes as ('salvaged',
    start, end, fields, block, reason), besides the gap that the member is or is part of."""
    at, lost, reason, had = 0, None, None, []
    while at < len(data):
        found, gaps, bad, end = [], [], None, None
        if data[at:at + 3] == GZIP:
            end, inner, bad = inflate(data, at)
            found, gaps = inner_records(inner)
            if bad:
                found = [x for x in found if _stated(x[0].get("warc-block-digest"))]
        else:
            try:
                end, fields, block = parse_record(data, at)
                if (fields, block) in had:  # stored in the damaged member and salvaged from it already
                    had.remove((fields, block))
                    at = end
                    continue
                found.append((fields, block))
            except Bad as e:
                gaps = [str(e)]
        if bad or (gaps and not found):
            if lost is None:
                lost, reason = at, bad or gaps[0]
            for fields, block in found:
                had.append((fields, block))
                yield "salvaged", at, end or len(data), fields, block, bad
            # A cut-off member may have been cut in the middle of the file.
            at = end if end and bad != "member cut off" else _candidate(data, at + 1)
            continue
        if lost is not None:
            yield "gap", lost, at, reason
            lost, had = None, []
        for why in gaps:
            yield "gap", at, end, why
        for fields, block in found:
            yield "record", at, end, fields, block
        at = end
    if lost is not None:
        yield "gap", lost, len(data), reason


def _unname(value: str | None) -> str | None:
    m = re.fullmatch(f"<{re.escape(URN)}(.*)>", value or "", re.S)
    return None if not value or (m and m[1] == "null") else m[1] if m else value


def _reader(with_payload: bool):
    names = [x.split()[0] for x in ROWS.split(", ")]

    def row(uri, item):
        kind, start, end, *rest = item
        if kind == "gap":
            return dict(zip(names, [kind, uri, start, end, rest[0]]))
        fields, block, *why = rest
        body, revisit = http_body(block), fields["warc-type"] == "revisit"
        stated = re.search(rb"(?im)^content-length:\s*(\d+)", block.partition(b"\r\n\r\n")[0]) if revisit else None
        digest = fields.get("warc-payload-digest", "")
        known = _stated(digest)
        return dict(zip(names, [
            kind, uri, start, end, why[0] if why else None, fields["warc-type"], _unname(fields["warc-record-id"]),
            fields.get("warc-target-uri"), _unname(fields.get("warc-refers-to")),
            base64.b32encode(known[1]).decode() if revisit and known and known[0] == "sha1" else
            digest.removeprefix("sha1:") if revisit else sha1_base32(body),
            int(stated[1]) if stated else len(body), body if with_payload and not revisit else None]))

    def run(batches):
        schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n in (
            "start", "end", "payload_bytes") else pa.string()) for n in names])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for item in salvage(whole_file(uri)):
                    rows.append(row(uri, item))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def read_warc(files: DataFrame, *, payload: bool = True) -> DataFrame:
    """Rows of the archives that ``files`` (column file) names: kind ``record``, or kind ``gap``
    for quarantined bytes (file, start, end, reason), or ``salvaged`` for a record whose digest
    holds in a member that doesn't (with the member's reason)."""
    spark: SparkSession = files.sparkSession
    n = max(files.count(), spark.sparkContext.defaultParallelism)
    return files.select("file").repartition(min(n, 10_000), "file").mapInArrow(_reader(payload), ROWS)
