"""Byte-level BPE against the tiktoken library, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tests.conftest import SF_SMALL
from tractlake.llm import bytebpe
from tractlake.llm.queries import REGISTRY

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
EDGES = [None, "", " ", "  \n\n \t x", "don't we'll it's", "a" * 5000, "日本語のテキスト。" * 40, "é‍👩‍👩‍👧 🇫🇷",
         "﻿\x00\x01", "<|endoftext|>", "x  y   z    q", "½²③ 12,345.67", "\r\n\r\n", "'S 'lL", "naïve—café…"]


def library(name):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(P.path(name)), special_tokens={})


def random_texts(n):
    rng = random.Random(5)
    alphabet = "ab cde  \n\tÄß日本🙂'.,!?0123_-s ́ﬁ"
    return ["".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_ids_spans_and_token_texts(name):
    bpe, lib = bytebpe.coder(P.path(name), P.PATTERN), library(name)
    texts = [t or "" for t in EDGES] + random_texts(300)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == lib.encode_ordinary(text)
        assert bpe.bytes_of(ids).tobytes() == text.encode()
        assert "".join(bpe.token_texts(ids)) == text
        # Brute force: the code points whose bytes a token's bytes meet.
        owner = [i for i, c in enumerate(text) for _ in c.encode()]
        first, end, split = bpe.spans(ids)
        at = 0
        for i, token in enumerate(ids.tolist()):
            size = len(lib.decode_single_token_bytes(token))
            assert (first[i], end[i]) == (owner[at], owner[at + size - 1] + 1)
            assert split[i] == (text.encode()[at:at + size] != text[first[i]:end[i]].encode())
            at += size
        assert bpe.digests(ids)[2] == split.sum()


def test_split_characters_counted_over_blocks(monkeypatch):
    monkeypatch.setattr(bytebpe, "HASHED", 3)
    bpe = bytebpe.coder(P.path(FILES[0]), P.PATTERN)
    for text in random_texts(100) + ["🙂👩‍👩‍👧" * 9]:
        ids, = bpe.encode([text])
        got = bpe.digests(ids)
        assert got[1] == hashlib.sha256(text.encode()).hexdigest() and got[2] == bpe.spans(ids)[2].sum()


def test_slices_change_nothing(monkeypatch):
    bpe, lib = bytebpe.coder(P.path(FILES[0]), P.PATTERN), library(FILES[0])
    rng = random.Random(9)
    pieces = ["word", " it's", "'s", " ", "  ", "\n", "café", "日本", "、", ", ", "12", "--", " ", "x'", "Я!"]
    for _ in range(200):
        text = "".join(rng.choices(pieces, k=80))
        parts = list(bytebpe.slices(text, 7))
        assert "".join(parts) == text and len(parts) > 1
        assert [i for p in parts for i in lib.encode_ordinary(p)] == lib.encode_ordinary(text)
    monkeypatch.setattr(bytebpe, "SLICE", 50)
    text = " ".join(pieces) * 30
    assert bpe.encode([text, "", text])[2].tolist() == lib.encode_ordinary(text)


def test_files_without_a_byte_or_a_merge_fail(tmp_path):
    import base64
    line = lambda t, r: base64.b64encode(t) + b" %d\n" % r
    path = tmp_path / "ranks"
    path.write_bytes(line(b"a", 0))
    with pytest.raises(ValueError, match="lacks single bytes"):
        bytebpe.ByteBpe(str(path), P.PATTERN)
    path.write_bytes(b"".join(line(bytes([b]), b) for b in range(256)) + line(b"abc", 256))
    with pytest.raises(ValueError, match="no merge"):
        bytebpe.ByteBpe(str(path), P.PATTERN)


def test_frames(spark):
    rows = [(i, t, 1, "k") for i, t in enumerate(EDGES)] + [(None, "null key", 2, "k"), (3, EDGES[3], 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, key string")
    lib = library(FILES[0])
    coded = bytebpe.encode(docs)
    got = coded.collect()
    assert sorted((r.key is None, r.key or 0, r.ids) for r in got) == sorted(
        (k is None, k or 0, lib.encode_ordinary(t or "")) for k, t, _, _ in rows)
    assert all(len(r.first) == len(r.end) == len(r.split) == len(r.ids) for r in got)
    back = bytebpe.decode(coded).collect()
    assert sorted((r.key is None, r.key or 0, r.text) for r in back) == sorted((k is None, k or 0, t or "") for k, t, _, _ in rows)
    cut = spark.createDataFrame([("a", None), ("b", lib.encode_ordinary("🙂")[:1])], "key string, ids array<int>")
    part = {r.key: (r.data, r.text) for r in bytebpe.decode(cut).collect()}
    assert part["a"] == (None, None) and part["b"][1] == "�" and "🙂".encode().startswith(bytes(part["b"][0]))
    with pytest.raises(Exception, match="not in the vocabulary"):
        bytebpe.decode(spark.createDataFrame([("a", [60000])], "key string, ids array<int>")).collect()
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bytebpe.encode(empty).collect() == [] and bytebpe.encode_and_check(empty).collect() == []
    assert bytebpe.decode(bytebpe.encode(empty)).collect() == []


def test_query_is_the_library(spark):
    lib = library(FILES[0])
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = lib.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in REGISTRY["op11_byte_bpe"][0](spark, SF_SMALL).collect()}
    assert got == want
