"""Byte-level BPE: ids of texts by a file of ranks, and back.

The ranks (a line a token: base64 of its bytes, its id) become a model of the tokenizers
library. That library works on characters, so each byte stands for one: printable ones for
themselves, the others for the characters from U+0100 on. A token's two halves are what its
bytes merge to by the ranks below its own; the merges, by rank, then do what the ranks say.
Each match of the pattern is encoded on its own, and one that is a token as it is stays one.

Arrow batches are cut into slices of at most ``SLICE`` characters of text for the library, which holds
about a hundred bytes a token. A longer text is cut where every match ends: behind a
letter or digit that white space or punctuation follows (an apostrophe excepted). Without such a place
it goes to the library whole.

Decoding looks the ids' bytes up and joins them. A character may be split over several
tokens: ``decode`` joins bytes before it reads characters, ``ByteBpe.token_texts`` gives such
a character to the token that ends it, and ``ByteBpe.spans`` says which characters each
token touches.

Defined cases: null and empty text have no ids (an empty list) and decode to the empty text;
a null list of ids decodes to null; bytes that are no UTF-8 (a list cut inside a character)
become U+FFFD in the decoded text, the bytes themselves are given too; an unknown id fails. A row gives a row:
null keys, repeated rows and ties stay. Columns besides key and text are neither read nor
able to clash; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE = 1 << 18
HASHED = 1 << 18  # ids that are decoded at once for a digest
# Letters and digits of old and settled blocks, and what ends their match.
BREAK = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-龥가-힣])"
                   r"(?=[\n !-&(-/:-@\[-`{-~、。，])")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable and no space."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def halves(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What the bytes of a token merge to by the ranks below its own."""
    own, parts = ranks[token], [token[i:i + 1] for i in range(len(token))]
    while True:
        pairs = [(ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(pairs, default=(own, 0))
        if rank >= own:
            return parts
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def slices(text: str, limit: int = SLICE):
    """Consecutive parts of ``text`` that encode to the same ids as the whole."""
    at = 0
    while len(text) - at > limit:
        cut = BREAK.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        ranks = read_ranks(path)
        char = byte_characters()
        spelt = lambda token: "".join(char[b] for b in token)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        merges = [halves(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
        if any(len(m) != 2 for m in merges):
            raise ValueError(f"{path} has tokens that no merge of two others makes")
        self.model = Tokenizer(models.BPE(vocab={spelt(t): r for t, r in ranks.items()},
                                          merges=[tuple(map(spelt, m)) for m in merges], ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # Decoding reverses the byte table: each id's characters back to bytes, end to end.
        byte = {c: b for b, c in enumerate(char)}
        top = max(ranks.values()) + 1
        of_id = [bytes(byte[c] for c in self.model.id_to_token(i) or "") for i in range(top)]
        self.size = np.fromiter(map(len, of_id), np.int64, top)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(of_id), np.uint8)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text, as unsigned 32-bit integers."""
        out, held, owner, size = [[] for _ in texts], [], [], 0

        def flush():
            for i, e in zip(owner, self.model.encode_batch_fast(held, add_special_tokens=False)):
                out[i].append(np.array(e.ids, "<u4"))
            held.clear()
            owner.clear()
        for i, text in enumerate(texts):
            for part in slices(text):
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= SLICE:
                    flush()
                    size = 0
        flush()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, joined."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("ids that are not in the vocabulary")
        each = self.size[ids]
        place = np.repeat(self.start[ids] - (np.cumsum(each) - each), each)
        place += np.arange(len(place))
        return self.flat[place]

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, end) code points that each token touches, and whether it begins or ends
        inside one. For ids of a whole text."""
        lead = (self.bytes_of(ids) & 0xC0) != 0x80
        begun = np.cumsum(lead)
        end = np.cumsum(self.size[ids])
        start = end - self.size[ids]
        inside = np.append(~lead, False)
        return begun[start] - 1, begun[end - 1], inside[start] | inside[end]

    def token_texts(self, ids: np.ndarray) -> list[str]:
        """A text a token; a character split over several goes to the one that ends it."""
        data, read = self.bytes_of(ids).tobytes(), codecs.getincrementaldecoder("utf-8")("replace")
        ends = np.cumsum(self.size[ids]).tolist()
        return [read.decode(data[a:b], final=b == len(data)) for a, b in zip([0, *ends], ends)]

    def digests(self, ids: np.ndarray) -> tuple[str, str, int]:
        """SHA-256 of the ids (little-endian, 32 bits) and of the bytes that they decode to,
        and the number of tokens that hold a part of a character only."""
        out, split, before = hashlib.sha256(), 0, True
        for a in range(0, len(ids), HASHED):
            part = ids[a:a + HASHED]
            data = self.bytes_of(part)
            out.update(data)
            lead = (data & 0xC0) != 0x80
            end = np.cumsum(self.size[part])
            first = lead[end - self.size[part]]
            whole = np.append(first[1:], True)  # does the next token start with a character?
            if not lead[0] and a and before:
                split += 1  # the token before the part, taken for whole, is not
            split += int((~(first & whole)).sum())
            before = bool(first[-1])
        return hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), out.hexdigest(), split


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return ByteBpe(path, pattern)


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def _groups(texts: pa.Array):
    """Row ranges of about ``SLICE`` bytes of text, or one longer row."""
    size, a = 0, 0
    for b, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        size += n
        if size >= SLICE:
            yield a, b
            size, a = 0, b
    if a < len(texts):
        yield a, len(texts)


def _over(docs: DataFrame, key: str, text: str, ranks: str | None, pattern: str | None, columns: str, row) -> DataFrame:
    """A row a document: key and what ``row(coder, ids)`` gives of its ids."""
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()
    schema = pa.schema([pa.field(n, _ARROW[t]) for n, t in (c.rsplit(" ", 1) for c in columns.split(", "))])

    def run(batches):
        bpe = coder(ranks, pattern)
        for batch in batches:
            for a, b in _groups(batch.column(1)):
                ids = bpe.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                made = list(zip(*[row(bpe, x) for x in ids]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[pa.array(v, f.type) for v, f in zip(made, schema)]],
                    ["key", *schema.names])
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {columns}")


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
          "array<boolean>": pa.list_(pa.bool_())}


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """key, ids, and for each token first and end (the code points it touches, end exclusive)
    and split (whether it holds a part of a character only)."""
    def row(bpe, ids):
        return ids.astype(np.int32), *[x.astype(t) for x, t in zip(bpe.spans(ids), (np.int32, np.int32, bool))]
    return _over(docs, key, text, ranks, pattern,
                 "ids array<int>, first array<int>, end array<int>, split array<boolean>", row)


def decode(coded: DataFrame, *, key: str = "key", ids: str = "ids", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """key, data (the bytes) and text of each list of ids."""
    rows = coded.select(coded[key].alias("key"), coded[ids].alias("ids"))
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()

    def run(batches):
        bpe = coder(ranks, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column(1)[i]
                data = bpe.bytes_of(x.values.to_numpy(zero_copy_only=False)).tobytes() if x.is_valid else None
                text = None if data is None else data.decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([data], pa.binary()),
                                                  pa.array([text], pa.string())], ["key", "data", "text"])
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, data binary, text string")


def encode_and_check(docs: DataFrame, *, key: str = "doc_id", text: str = "text", ranks: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 (of the bytes that the ids decode to) and
    n_split (tokens that hold a part of a character only)."""
    def row(bpe, ids):
        return len(ids), *bpe.digests(ids)
    return _over(docs, key, text, ranks, pattern,
                 "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split bigint", row)
