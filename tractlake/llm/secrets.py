r"""Secret scans by a recursive decoding worklist.

A layer is a text together with, for each of its characters, the range of characters of the
document that it comes from. The worklist starts with the document itself. Each layer is
scanned with the base patterns, and unwrapped:

* URL: runs of ``%XX`` become the characters of their UTF-8 bytes, in place;
* Unicode: ``\uXXXX`` (pairs of surrogates joined), ``\UXXXXXXXX``, ``\u{...}`` and ``\xXX``
  become their characters, in place;
* compressed data spelt in either way is decompressed, as below;
* base64 (both alphabets, with or without padding, in one line or wrapped): a run that
  decodes to text is a layer of its own; one that decodes to gzip, zlib, bzip2 or xz data is
  decompressed first, and compressed data inside compressed data again. A run that decodes
  to neither is decoded from all four alignments, and from each '/', '-' and '_' on.

All members of concatenated compressed data are read, and what follows them. Decoded bytes
that aren't UTF-8 become U+FFFD, and the rest of the layer is scanned.

What is new goes onto the worklist until nothing is. A layer is known by its text and its
ranges, so unwrapping that comes round again (a cycle), or comes to the same place by
another way, ends there; a chain of compressed data ends where a content repeats.
Hits in a layer count as spans from the first to the last document character that they come
from. Spans found twice count once; those of the document itself are its base spans.

Data that hold UTF-16 text (every second byte of a run is zero) are read as such too, in
either byte order.

Memory: decompressed content of more than ``LAYER_BYTES`` is read as a stream, in windows of
that size that overlap by ``OVERLAP``, each a layer. A layer of decoded data stands for the whole
run that it came from, so a hit has the same span in whichever window it is found; one that is longer than the
overlap is found by the part in a window. What spans more than a window is only unwrapped
as far as a window holds it. ``n_cut`` counts such contents.

Defined cases: null and empty text have no spans; repeated rows are scanned alike; a null key
passes through; an empty table gives an empty result; columns besides key and text are not
read.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LAYER_BYTES = 1 << 26
OVERLAP = 1 << 20
CHAIN = 100  # compressed layers inside one another, of contents too long to tell a cycle
ROWS = 256
# The kinds in their order, with pattern, group that counts and its least length.
KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{8,}+(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
STANDARD = str.maketrans("-_", "+/")
BINARY = re.compile(rb"[^\t-\r\x20-\x7e]")
URL_BYTES, URL_BYTE = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/!*'()-])+"), re.compile(r"%[0-9A-Fa-f]{2}|.", re.S)
X_BYTES = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0'"\\]|[\x20-\x5b\x5d-\x7e])+""")
X_BYTE = re.compile(r"\\x[0-9A-Fa-f]{2}|\\.|.", re.S)
ESCAPES = dict(zip("abfnrtv0'\"\\", b"\a\b\f\n\r\t\v\0'\"\\"))
MAGIC = re.compile(rb"\x1f\x8b|x[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00")
WORTH = re.compile(rb"[\x20-\x7e]{8}")  # every hit, and all that can unwrap to one, has such a run
WIDE_LITTLE, WIDE_BIG = re.compile(rb"(?:[\x20-\x7e\t\r\n]\0){8}"), re.compile(rb"(?:\0[\x20-\x7e\t\r\n]){8}")
PACKED = (b"\x1f\x8b", b"x\x01", b"x\x5e", b"x\x9c", b"x\xda", b"BZh", b"\xfd7zXZ\x00")

SPAN = "array<struct<kind:string,start:bigint,end:bigint,depth:int>>"


class Layer:
    """``text`` with the range of document characters of each of its characters. Without
    ``starts`` all characters stand for ``whole`` (None: the document itself)."""

    __slots__ = ("text", "starts", "ends", "whole", "depth")

    def __init__(self, text, depth, starts=None, ends=None, whole=None):
        self.text, self.depth, self.starts, self.ends, self.whole = text, depth, starts, ends, whole

    def place(self, a: int, b: int) -> tuple[int, int]:
        """Document characters of the layer's characters a to b."""
        if self.whole is not None:
            return self.whole
        if self.starts is None:
            return a, b
        return self.starts[a], self.ends[b - 1]

    def key(self) -> tuple:
        ranges = hash((tuple(self.starts), tuple(self.ends))) if self.starts is not None else self.whole
        return hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest(), ranges


def base_hits(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) in a text, each kind leftmost and not overlapping."""
    for kind, (pattern, group, least) in KINDS.items():
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                yield kind, m.start(), m.end()


def _in_place(layer: Layer, pattern: re.Pattern, units) -> Layer | None:
    """The layer with each match replaced by ``units(match)``: (character, start, end) in it."""
    parts, starts, ends, at, changed = [], [], [], 0, False

    def copy(a, b):
        parts.append(layer.text[a:b])
        for i in range(a, b):
            s, e = layer.place(i, i + 1)
            starts.append(s)
            ends.append(e)
    for m in pattern.finditer(layer.text):
        new = units(m)
        if new is None:
            continue
        changed = True
        copy(at, m.start())
        for char, a, b in new:
            parts.append(char)
            s, e = layer.place(a, b)
            starts.append(s)
            ends.append(e)
        at = m.end()
    if not changed:
        return None
    copy(at, len(layer.text))
    if layer.whole is not None:
        return Layer("".join(parts), layer.depth + 1, whole=layer.whole)
    return Layer("".join(parts), layer.depth + 1, starts, ends)


def _url_units(m: re.Match):
    """Characters of a run of %XX; bytes that aren't UTF-8 stay as U+FFFD, one for each."""
    data, a, out, i = bytes.fromhex(m[0].replace("%", "")), m.start(), [], 0
    while i < len(data):
        n = 1 if data[i] < 0xC0 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
        try:
            out.append((data[i:i + n].decode(), a + 3 * i, a + 3 * min(i + n, len(data))))
        except UnicodeDecodeError:
            n = 1
            out.append(("�", a + 3 * i, a + 3 * i + 3))
        i += n
    return out


def _unicode_units(m: re.Match):
    text, a = m[0], m.start()
    if text.startswith("\\x"):
        return [(chr(int(text[i + 2:i + 4], 16)), a + i, a + i + 4) for i in range(0, len(text), 4)]
    if text.startswith("\\u{") or text.startswith("\\U"):
        code = int(text[3:-1] if text[2] == "{" else text[2:], 16)
        return [(chr(code), a, m.end())] if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    codes, out, i = [int(text[i + 2:i + 6], 16) for i in range(0, len(text), 6)], [], 0
    while i < len(codes):
        pair = 0xD800 <= codes[i] < 0xDC00 and i + 1 < len(codes) and 0xDC00 <= codes[i + 1] < 0xE000
        code = 0x10000 + ((codes[i] - 0xD800) << 10) + codes[i + 1] - 0xDC00 if pair else codes[i]
        n = 2 if pair else 1
        out.append((chr(code) if not 0xD800 <= code < 0xE000 else "�", a + 6 * i, a + 6 * (i + n)))
        i += n
    return out


def _text_of(data: bytes) -> str | None:
    """Data as text if that's what it is: UTF-8, printable but for white space."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and (text.isprintable() or re.sub(r"\s", "", text).isprintable()) else None


def _unpack(data: bytes, limit: int) -> tuple[bytes, bool] | None:
    """(content, whether it was cut at ``limit``) of compressed data, or None: of all members that
    follow one another, and then what comes after them."""
    parts, size = [], 0
    while data.startswith(PACKED):
        try:
            if data.startswith(b"BZh"):
                z = bz2.BZ2Decompressor()
            elif data.startswith(b"\xfd7zXZ"):
                z = lzma.LZMADecompressor()
            else:
                z = zlib.decompressobj(47)
            parts.append(z.decompress(data, limit - size))
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            break
        size += len(parts[-1])
        if not z.eof:
            return b"".join(parts), size >= limit
        data = z.unused_data
        if size >= limit:
            return b"".join(parts), bool(data)
    return (b"".join([*parts, data]), False) if parts else None


def _content(data: bytes, limit: int) -> tuple[bytes, bool]:
    """(content, cut) of data, through all compressed layers."""
    seen, cut = set(), False
    while data.startswith(PACKED):
        got = _unpack(data, limit)
        digest = hashlib.sha256(data).digest()
        if got is None or digest in seen:
            break
        seen.add(digest)
        data, now = got
        cut |= now
    return data, cut


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, run): runs on one line, and joined lines of equal length with the line
    before and a shorter one after, and without."""
    for m in BASE64.finditer(text):
        yield m.start(), m.end(), m[0]
    for m in WRAPPED.finditer(text) if "\n" in text else ():
        lines = [x.span() for x in LINE.finditer(text, m.start(), m.end())]
        size, i = [b - a for a, b in lines], 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and size[j] == size[i]:
                j += 1
            for a in {i, max(i - 1, 0)}:
                for b in {j, min(j + 1, len(lines))}:
                    if b - a > 1 and sum(size[a:b]) >= 16:
                        end = m.end() if b == len(lines) else lines[b - 1][1]
                        yield lines[a][0], end, "".join(text[x:y] for x, y in lines[a:b])
            i = j


def _texts(data: bytes, limit: int) -> tuple[Iterator[str], bool, bytes]:
    """(texts of data through all compressed layers, whether they come in windows, the first content)."""
    content, cut = _content(data, limit)
    if not cut:
        return iter(_layers(content)), False, content
    return (x for w in _windows(data, limit) for x in _layers(w)), True, content


def _run_contents(run: str, limit: int) -> tuple[list[tuple[int, Iterator[str]]], int]:
    """([(characters of the run before them, texts)], contents in windows) that a base64 run stands for."""
    out, cuts, run = [], 0, run.rstrip("=")
    plain = run.translate(STANDARD)
    for skip in range(4):
        part = plain[skip:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        if not skip:
            texts, cut, content = _texts(data, limit)
            if content is not data or _text_of(data) is not None:
                return [(0, texts)], int(cut)
            if WIDE_LITTLE.match(data) or WIDE_BIG.match(data):
                return [(0, iter(_layers(data)))], 0
        marks = [i + 1 for i in range(len(run) - 1) if run[i] in "/-_" and (i + 1 - skip) % 4 == 0 and i + 1 > skip]
        for at in marks:
            place = (at - skip) // 4 * 3
            if data.startswith(PACKED, place):
                texts, cut, content = _texts(data[place:], limit)
                if len(content) and not content.startswith(PACKED):
                    out.append((at, texts))
                    cuts += cut
        last = max((m.end() for m in BINARY.finditer(data)), default=0)
        at = next((x for x in marks if (x - skip) // 4 * 3 >= last), None)
        head, tail = (data, b"") if at is None else (data[:(at - skip) // 4 * 3], data[(at - skip) // 4 * 3:])
        out += [(at, iter(x)) for x in (_layers(tail),) if x]
        out += [(skip, iter(x)) for x in (_layers(head),) if x]
    return out, cuts


def _layers(data: bytes) -> list[str]:
    """The texts of data, as UTF-8 and where it looks so as UTF-16; bytes that are neither become
    U+FFFD, which no pattern has. None for data without a run that a hit needs."""
    out = [data.decode("utf-8", "replace")] if WORTH.search(data) else []
    if b"\0" in data:
        for pattern, name in ((WIDE_LITTLE, "utf-16-le"), (WIDE_BIG, "utf-16-be")):
            # Both parities: texts of either may follow one another.
            for odd in {m.start() % 2 for m in pattern.finditer(data)}:
                out.append(data[odd:].decode(name, "replace"))
    return out


def _windows(data: bytes, limit: int) -> Iterator[bytes]:
    """The content of compressed data through all layers, in windows that overlap."""
    stream, inner = iter([data]), 0
    while inner < CHAIN:
        head = b""
        for part in stream:
            head += part
            if len(head) >= 6:
                break
        stream = chain([head], stream)
        if not head.startswith(PACKED):
            break
        stream, inner = _inflated(stream, min(limit, 1 << 20)), inner + 1
    held = b""
    for part in stream:
        held += part
        while len(held) >= limit:
            yield held[:limit]
            held = held[limit - min(OVERLAP, limit // 2):]
    if held:
        yield held


def _inflated(stream: Iterator[bytes], step: int) -> Iterator[bytes]:
    """The content of a stream of compressed members, and what follows them, in pieces."""
    rest, z = b"", None
    for part in chain(stream, [None]):
        rest += part or b""
        while rest:
            if z is None:
                if part is not None and len(rest) < 6:
                    break
                if not rest.startswith(PACKED):
                    yield rest
                    rest = b""
                    break
                z = (bz2.BZ2Decompressor() if rest.startswith(b"BZh") else lzma.LZMADecompressor()
                     if rest.startswith(b"\xfd7zXZ") else zlib.decompressobj(47))
            try:
                content = z.decompress(rest, step)
                rest = getattr(z, "unconsumed_tail", b"")
                yield content
                while not z.eof and not getattr(z, "needs_input", not rest):  # more comes out of what it has
                    content = z.decompress(rest, step)
                    rest = getattr(z, "unconsumed_tail", b"")
                    yield content
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                return
            if z.eof:
                rest, z = z.unused_data, None


def _packed_runs(text: str, limit: int) -> Iterator[tuple[int, int, Iterator[str], bool]]:
    """(start, end, texts, whether in windows) of compressed data spelt with %XX or \\xXX, with characters
    that stand for themselves in between."""
    for sign, run, unit in (("%", URL_BYTES, URL_BYTE), ("\\x", X_BYTES, X_BYTE)):
        for m in run.finditer(text) if sign in text else ():
            if sign not in m[0]:
                continue
            units = [(x.start(), x[0]) for x in unit.finditer(m[0])]
            data = bytes(int(u[-2:], 16) if len(u) > 2 else ESCAPES.get(u[1:], 0) if len(u) == 2 else ord(u)
                         for _, u in units)
            done = 0
            for x in MAGIC.finditer(data):
                if x.start() < done:
                    continue
                texts, cut, content = _texts(data[x.start():], limit)
                if not content.startswith(PACKED) and (cut or _layers(content)):
                    yield m.start() + units[x.start()][0], m.end(), texts, cut
                    done = len(data)


def _below(layer: Layer, texts: Iterator[str], a: int, b: int) -> Iterator[Layer]:
    whole = layer.place(a, b)
    return (Layer(x, layer.depth + 1, whole=whole) for x in texts)


def scan_text(text: str, limit: int = LAYER_BYTES) -> tuple[list[tuple[str, int, int, int]], int]:
    """(spans (kind, start, end, depth), contents read in windows) of a document; depth 0 are the base spans."""
    spans: dict[tuple[str, int, int], int] = {}
    todo, seen, cuts = [Layer(text, 0)], set(), 0
    while todo:
        layer = todo.pop()
        if not isinstance(layer, Layer):  # layers still to come, one at a time
            source, layer = layer, next(layer, None)
            if layer is None:
                continue
            todo.append(source)
        if layer.depth:
            key = layer.key()
            if key in seen:
                continue
            seen.add(key)
        for kind, a, b in base_hits(layer.text):
            spans.setdefault((kind, *layer.place(a, b)), layer.depth)
        if "%" in layer.text:
            todo.append(_in_place(layer, URL, _url_units))
        if "\\" in layer.text:
            todo.append(_in_place(layer, UNICODE, _unicode_units))
        for a, b, contents, cut in _packed_runs(layer.text, limit):
            cuts += cut
            todo.append(_below(layer, contents, a, b))
        for a, b, run in _base64_runs(layer.text):
            found, cut = _run_contents(run, limit)
            cuts += cut
            for skip, contents in found:
                # Places in joined lines aren't the run's; those layers stand for all of it.
                todo.append(_below(layer, contents, a + (skip if b - a <= len(run) else 0), b))
        todo = [x for x in todo if x is not None]
    return [(*k, d) for k, d in spans.items()], cuts


def _scanner(limit: int):
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("depth", pa.int32())]))
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                found = [scan_text(t or "", limit) for t in part.column(1).to_pylist()]
                spans = [[dict(zip(("kind", "start", "end", "depth"), s)) for s in x] for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(spans, kind), pa.array([c for _, c in found], pa.int64())],
                    ["key", "spans", "n_cut"])
    return run


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", limit: int = LAYER_BYTES) -> DataFrame:
    """key, spans (kind, start, end, depth), n_cut: one row per document."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _scanner(limit), f"key {kind}, spans {SPAN}, n_cut bigint")


def spelt(spans: Column) -> Column:
    """kind:start:end of spans by start, kind (in the order of KINDS) and end, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
