"""Token ids in wavelet matrices: one compressed file a shard.

Documents are dealt by ranges of the key and sorted, so the shards in order hold them in
ascending order of the key. A task encodes each text, appends the end id and closes a shard
at ``SHARD_TOKENS`` tokens (a document is never split). The manifest has a row a shard; its
running sum is the number of tokens before each shard.

File: ``MAGIC``, the length of the head, the head (JSON), then the parts it names.
* For each of the 16 bits, highest first, a plane: the tokens' bits in the order that the
  planes above give, zeros before ones (stable). A plane is cut into blocks of ``BLOCK``
  bytes, compressed one by one; a directory has each block's place and the ones before it.
* The documents' keys and starts.
So access, counting and lookup of occurrences read a few blocks of each plane, and reading
all tokens undoes the planes from the last to the first.

Encoding uses the tokenizers library. Words met before come from a table, new ones go to
the library together; a text whose words depend on one another (runs of white space, names
of special tokens) goes to it whole.

Defined cases: null and empty text have the end id only; a null key comes first; repeated
rows follow one another, ties in the key are in the order of the text; an empty table gives
no file; columns besides key and text are neither read nor able to clash.
"""

from __future__ import annotations

import functools
import io
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tractlake.llm.common import written
from tractlake.llm.files import new_file, random_file, whole_file
from tractlake.session import scratch_dir

MAGIC = b"WVM1"
BITS = 16
BLOCK = 1 << 13
SHARD_TOKENS = 1 << 21
END_ID = 0
KNOWN_WORDS = 1 << 20
LONG = 64  # characters; longer words (texts without spaces) are not kept
PORTION = 1 << 23
TASK_SHARDS = 4  # read by a task, one after the other
WHITE = re.compile(r"\s")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LATIN = "\u024f"  # the last letter of Latin Extended-B
NEW = object()

MANIFEST = "part int, seq int, file string, n_docs bigint, n_tokens bigint"


# --- The file ----------------------------------------------------------------------------

def build(tokens: np.ndarray, keys: list, starts: np.ndarray) -> bytes:
    """The file of ``tokens`` (below 2 ** 16) and of the documents that start at ``starts``."""
    pack = zstandard.ZstdCompressor(level=1).compress
    now, planes, body = tokens.astype(np.uint16), [], io.BytesIO()

    def put(data: bytes) -> list[int]:
        at = body.tell()
        body.write(data)
        return [at, len(data)]
    for bit in range(BITS - 1, -1, -1):
        after, count, places = np.empty_like(now), [0], []
        packed = np.packbits((now >> np.uint16(bit)).astype(np.uint8) & 1)
        zeros = len(now) - int(np.bitwise_count(packed).sum(dtype=np.int64))
        # Block by block, so that what is worked on stays in the processor's cache.
        for a in range(0, len(packed), BLOCK):
            block, part = packed[a:a + BLOCK], now[8 * a:8 * (a + BLOCK)]
            mask = np.unpackbits(block, count=len(part)).view(bool)
            one = np.flatnonzero(mask)
            before = count[-1]
            after[zeros + before:zeros + before + len(one)] = part[one]
            after[8 * a - before:8 * a - before + len(part) - len(one)] = part[np.flatnonzero(~mask)]
            count.append(before + len(one))
            places.append(put(pack(block.tobytes())))
        planes.append({"zeros": zeros, "ones": put(np.array(count, "<i8").tobytes()),
                       "blocks": put(np.array(places, "<i8").reshape(-1, 2).tobytes())})
        now = after
    docs = {"keys": put(pack(json.dumps(keys).encode())), "starts": put(pack(np.asarray(starts, "<i8").tobytes()))}
    head = json.dumps({"n": len(tokens), "planes": planes, **docs}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + body.getvalue()


class WaveletMatrix:
    """A shard's file, read block by block as needed."""

    def __init__(self, f):
        self.f = f
        if f.read(4) != MAGIC:
            raise ValueError("not a shard of token ids")
        size, = struct.unpack("<I", f.read(4))
        self.head = json.loads(f.read(size))
        self.base = 8 + size
        self.n = self.head["n"]
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.zeros = [p["zeros"] for p in self.head["planes"]]
        self.ones = [np.frombuffer(self._get(p["ones"]), "<i8") for p in self.head["planes"]]
        self.blocks = [np.frombuffer(self._get(p["blocks"]), "<i8").reshape(-1, 2) for p in self.head["planes"]]
        self._block = functools.lru_cache(maxsize=64)(self._read_block)

    def _get(self, place) -> bytes:
        self.f.seek(self.base + int(place[0]))
        return self.f.read(int(place[1]))

    def _read_block(self, plane: int, block: int) -> np.ndarray:
        return np.frombuffer(self.unpack(self._get(self.blocks[plane][block]), max_output_size=BLOCK), np.uint8)

    def keys(self) -> list:
        return json.loads(self.unpack(self._get(self.head["keys"])))

    def starts(self) -> np.ndarray:
        return np.frombuffer(self.unpack(self._get(self.head["starts"])), "<i8")

    def _bit_and_ones(self, plane: int, i: int) -> tuple[int, int]:
        """The bit at ``i`` of a plane and the number of ones before it."""
        block, inside = divmod(i, 8 * BLOCK)
        if block == len(self.blocks[plane]):
            return 0, int(self.ones[plane][-1])
        data = self._block(plane, block)
        byte, bit = divmod(inside, 8)
        if byte == len(data):
            return 0, int(self.ones[plane][-1])
        before = int(self.ones[plane][block]) + int(np.bitwise_count(data[:byte]).sum(dtype=np.int64))
        here = int(data[byte])
        return here >> (7 - bit) & 1, before + (here >> (8 - bit)).bit_count()

    def access(self, i: int) -> int:
        """Token ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in range(BITS):
            bit, ones = self._bit_and_ones(plane, i)
            token = token << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return token

    def _descend(self, token: int, i: int) -> tuple[int, int]:
        """Where the run of ``token`` starts below the last plane, and where place ``i`` leads in it."""
        start = 0
        for plane in range(BITS):
            a, b = self._bit_and_ones(plane, start)[1], self._bit_and_ones(plane, i)[1]
            if token >> (BITS - 1 - plane) & 1:
                start, i = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                start, i = start - a, i - b
        return start, i

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` occurs before place ``i``."""
        start, end = self._descend(token, min(max(i, 0), self.n))
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of occurrence ``k`` (from 0) of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._descend(token, 0)[0] + k
        for plane in range(BITS - 1, -1, -1):
            at = self._select_bit(plane, token >> (BITS - 1 - plane) & 1, at - (
                self.zeros[plane] if token >> (BITS - 1 - plane) & 1 else 0))
        return at

    def _select_bit(self, plane: int, bit: int, k: int) -> int:
        """The place of the ``k``-th (from 0) one or zero of a plane."""
        before = self.ones[plane] if bit else np.arange(len(self.ones[plane])) * 8 * BLOCK - self.ones[plane]
        block = int(np.searchsorted(before[:-1], k, "right")) - 1
        bits = np.unpackbits(self._block(plane, block))
        return block * 8 * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens: the planes are undone from the last to the first, block by block."""
        now = np.zeros(self.n, np.uint16)
        for plane in range(BITS - 1, -1, -1):
            up, zeros, value = np.empty_like(now), self.zeros[plane], np.uint16(1 << (BITS - 1 - plane))
            for block in range(len(self.blocks[plane])):
                part, before = up[8 * BLOCK * block:8 * BLOCK * (block + 1)], int(self.ones[plane][block])
                mask = np.unpackbits(self._read_block(plane, block), count=len(part)).view(bool)
                one, start = np.flatnonzero(mask), 8 * BLOCK * block - before
                part[one] = now[zeros + before:zeros + before + len(one)] | value
                part[np.flatnonzero(~mask)] = now[start:start + len(part) - len(one)]
            now = up
        return now


def open_shard(uri: str) -> WaveletMatrix:
    """A shard for access, counting and lookup, fetched block by block."""
    return WaveletMatrix(random_file(uri))


# --- Encoding ----------------------------------------------------------------------------

class Encoder:
    """ids of texts by a byte-level tokenizer file, with a table of the words met before.

    The pre-tokenizer cuts before every space that isn't inside a run of white space, and
    around a line feed between other characters. So a text without such runs is a list of
    words, each after a space or a line feed, whose ids don't depend on one another. New
    words go to the library together, a line feed apart: none of them has its id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.t = Tokenizer.from_file(path)
        if self.t.get_vocab_size() > 1 << BITS:
            raise ValueError("the vocabulary has more ids than the planes hold")
        self.special = [x.content for x in self.t.get_added_tokens_decoder().values()]
        self.line, = self._ids("\n")
        self.line_bytes = np.array([self.line], "<u2").tobytes()
        # By the word after a space, after NUL (a line feed) or after SOH (the start of the text).
        # None: not a plain word.
        self.known: dict[str, bytes | None] = {}
        self.ends: dict[str, bytes] = {}
        self.long: list[str] = []  # words and endings to forget after this column

    def _ids(self, text: str) -> list[int]:
        return self.t.encode(text, add_special_tokens=False).ids

    def _together(self, words: list[str]) -> list[bytes]:
        """ids of words without white space but for a space in front."""
        out = []
        for a in range(0, len(words), 4096):
            part = words[a:a + 4096]
            # Without offsets: of the ways into the library the cheapest.
            found, = self.t.encode_batch_fast(["\n".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, "<u2")
            ends = [*np.flatnonzero(ids == self.line).tolist(), len(ids)]
            if len(ends) != len(part):
                raise ValueError("the tokenizer doesn't cut at line feeds")
            data, start = ids.tobytes(), 0
            for end in ends:
                out.append(data[2 * start:2 * end])
                start = end + 1
        return out

    def learn(self, words: list[str]) -> None:
        """Adds new words to the table."""
        known = self.known
        known["\1"] = b""
        spaced, lined, firsts = [], [], []
        for w in words:
            kind = lined if w[:1] == "\0" else firsts if w[:1] == "\1" else spaced
            rest = w if kind is spaced else w[1:]
            if rest and not WHITE.search(rest):
                kind.append(w)
            elif w != "\1":
                known[w] = None
        known.update(zip(spaced, self._together([" " + w for w in spaced])))
        known.update((w, self.line_bytes + x) for w, x in zip(lined, self._together([w[1:] for w in lined])))
        known.update(zip(firsts, self._together([w[1:] for w in firsts])))
        self.long += [w for w in words if len(w) > LONG]

    def _looked_up(self, distinct: pa.Array) -> list[bytes | None]:
        """ids of each distinct word; None: not a plain word. The pre-tokenizer cuts between a
        letter or digit and punctuation, so a word that ends in punctuation is its stem and
        that end, and only stems are looked up."""
        stem = pc.utf8_rtrim(distinct, PUNCTUATION)
        last = pc.utf8_slice_codeunits(stem, -1)
        ended = pc.and_(pc.not_equal(stem, distinct), pc.and_(
            pc.utf8_is_alnum(last), pc.less_equal(last, pa.scalar(LATIN, pa.large_string()))))
        base = pc.if_else(ended, stem, distinct).dictionary_encode()
        listed = lambda x: x.to_numpy(zero_copy_only=False).tolist()
        names, known = listed(base.dictionary), self.known
        found = [known.get(w, NEW) for w in names]
        new = [i for i, x in enumerate(found) if x is NEW]
        self.learn([names[i] for i in new])
        for i in new:
            found[i] = known[names[i]]
        ids = [found[i] for i in listed(base.indices)]
        at = np.flatnonzero(ended.to_numpy(zero_copy_only=False)).tolist()
        tails = [w[n:] for w, n in zip(listed(distinct.filter(ended)), listed(pc.utf8_length(stem.filter(ended))))]
        unmet = list(set(tails).difference(self.ends))
        self.ends.update(zip(unmet, self._together(unmet)))
        self.long += [x for x in unmet if len(x) > LONG]
        for i, x in zip(at, tails):
            if ids[i] is not None:
                ids[i] += self.ends[x]
        return ids

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """ids of each text, as 16-bit integers. Each distinct word of the column is looked up
        once; the ids of all its places are gathered from there."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
            self.ends.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = functools.reduce(pc.or_, [pc.match_substring(texts, s) for s in ("\0", "\1", *self.special)])
        wide = functools.partial(pa.scalar, type=pa.large_string())
        marked = pc.binary_join_element_wise(wide("\1"), pc.if_else(odd, wide(""), texts), wide(""))
        cut = pc.split_pattern(pc.replace_substring(marked, "\n", " \0"), " ")
        words = cut.flatten().dictionary_encode()
        code = words.indices.to_numpy()
        found = self._looked_up(words.dictionary)
        plain = np.array([x is not None for x in found], bool)
        ids = [x or b"" for x in found]
        flat = np.frombuffer(b"".join(ids), "<u2")
        # Tokens of a portion are fewer than its bytes, which are below 2 ** 31.
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 2
        each = size[code]
        upto = np.cumsum(each, dtype=np.int32)
        # Where a token comes from: its place plus how far its word's ids lie from there.
        place = np.repeat((np.cumsum(size, dtype=np.int32) - size)[code] - (upto - each), each)
        place += np.arange(len(place), dtype=np.int32)
        tokens = flat[place]
        last = np.cumsum(pc.list_value_length(cut).to_numpy())
        end = upto[last - 1] if len(last) else last
        whole = odd.to_numpy(zero_copy_only=False)
        if not plain.all():
            owner = np.repeat(np.arange(len(last)), np.diff(last, prepend=0))
            whole = whole | np.bincount(owner, ~plain[code], minlength=len(last)).astype(bool)
        out = [tokens[a:b] for a, b in zip([0, *end.tolist()], end.tolist())]
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self._ids(texts[i].as_py()), "<u2")
        for w in self.long:
            self.known.pop(w, None)
            self.ends.pop(w, None)
        self.long = []
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# --- Shards on Spark ----------------------------------------------------------------------

def _portions(batch):
    """Slices of a batch with about ``PORTION`` bytes of text (or one longer row)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PORTION, "right")))
        yield batch.slice(a, b - a)
        a = b


def _writer(folder: str, tokenizer: str, end_id: int, limit: int):
    end = np.array([end_id], "<u2")

    def run(batches):
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, pieces, starts, size = [], [], [], 0

        def close():
            data = build(np.concatenate(pieces), keys, np.array(starts, np.int64))
            uri, out = new_file(folder, ".wvm")
            with out:
                out.write(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([uri]),
                 pa.array([len(keys)], pa.int64()), pa.array([size], pa.int64())],
                ["part", "seq", "file", "n_docs", "n_tokens"])
        for batch in batches:
            for rows in _portions(batch):
                for key, ids in zip(rows.column(0).to_pylist(), enc.encode_column(rows.column(1))):
                    keys.append(key)
                    starts.append(size)
                    pieces += [ids, end]
                    size += len(ids) + 1
                    if size >= limit:
                        yield close()
                        keys, pieces, starts, size, seq = [], [], [], 0, seq + 1
        if keys:
            yield close()
    return run


def write_shards(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                 end_id: int = END_ID, folder: str | None = None, limit: int = SHARD_TOKENS) -> DataFrame:
    """The manifest: part, seq, file, n_docs, n_tokens, and start, the tokens of all shards before.
    Keys are numbers or strings."""
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    made = written(ordered.mapInArrow(_writer(folder, tokenizer or default_tokenizer(), end_id, limit), MANIFEST),
                   "tokens-manifest")
    # A row a shard: a few thousand rows a billion documents.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, key_type: str = "bigint") -> DataFrame:
    """key, start, n_tokens, ids_crc32 of each document, from the files."""
    def run(batches):
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # All of the file is needed, so it is fetched at once (a few MB).
                shard = WaveletMatrix(io.BytesIO(whole_file(uri)))
                tokens, keys, starts = shard.tokens().astype("<u4"), shard.keys(), shard.starts()
                ends = np.append(starts[1:], len(tokens))
                data = memoryview(tokens).cast("B")
                crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string() if key_type == "string" else pa.int64()), pa.array(starts + start),
                     pa.array(ends - starts), pa.array(crc, pa.int64())], ["key", "start", "n_tokens", "ids_crc32"])
    n = max(-(-manifest.count() // TASK_SHARDS), manifest.sparkSession.sparkContext.defaultParallelism)
    return (manifest.select("file", "start").repartition(min(n, 10_000), "file")
            .mapInArrow(run, f"key {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint"))
