"""The trie against a dictionary of prefixes, on rows with every edge case."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractlake.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth int, token string"


def own_turns(rows):
    out = collections.defaultdict(list)
    for r in rows:
        if r[0] is not None:
            out[r[0]].append(r)
    token = lambda x: hashlib.sha256(f"{len(x[0].encode())}:{x[0]}{x[1]}".encode()).hexdigest()[:32]
    for turns in out.values():
        turns[:] = [x for _, _, _, x in sorted((r[1] is not None, r[1] or 0, (r[2] or "", token((r[2] or "", r[3] or ""))),
                                                (r[2] or "", r[3] or "")) for r in turns)]
    return out


def brute(rows, rebuild=True):
    own = own_turns(rows)
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:]) if rebuild else tuple(turns)
    members, kids = collections.defaultdict(list), collections.defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[:d - 1]].add(s[:d])
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return collections.Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]) if p in kids else 0, leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest())
        for p, m in list(members.items()))


def got(df, rebuild=True):
    conv = F.col("conv")
    how = {"base": conv - conv % 5, "head": F.crc32(conv.cast("string").cast("binary")) % 9} if rebuild else {}
    return collections.Counter(map(tuple, prefixtrie.trie(df, **how).collect()))


def make(n, seed, depth=6, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, n):
        for t in range(rng.randrange(1, depth + 1)):
            rows.append((c, t, rng.choice(["user", None, "é"][:2 + c % 2]), rng.choice(["a", "bb", "日本"][:words])))
    rows += [(7, None, None, None), (7, None, "", ""), (7, 2, "x", "y" * 30_000), (7, 2, "x", "y" * 30_000),
             (None, 1, "user", "no conversation"), (10 ** 12, 1, "user", None)]
    return [(*r, "clash", 1, "clash") for r in rows]


@pytest.mark.parametrize("seed, shard, band", [(1, 1 << 15, 64), (2, 9, 64), (3, 4, 2), (4, 1 << 15, 3), (5, 7, 1)])
def test_rebuilt_against_brute_force(spark, monkeypatch, seed, shard, band):
    """Small shards make prefixes that reach over several; small bands make groups and chains."""
    monkeypatch.setattr(prefixtrie, "SHARD_KEYS", shard)
    monkeypatch.setattr(prefixtrie, "BAND", band)
    rows = make(60, seed, 14 if band == 3 else 6)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_plain_conversations_with_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SHARD_KEYS", 5)
    monkeypatch.setattr(prefixtrie, "BAND", 4)
    long = [(c, t, "user", f"turn {t}" if t < 9 + c % 2 else f"own {c % 7} {t}", "", 0, "") for c in range(40) for t in range(13)]
    rows = make(20, 8) + [(c + 100, *r) for c, *r in long]
    assert got(spark.createDataFrame(rows, SCHEMA), rebuild=False) == brute(rows, rebuild=False)


def test_empty_and_without_conversation(spark):
    assert not got(spark.createDataFrame([], SCHEMA))
    assert not got(spark.createDataFrame([(None, 1, "a", "b", "", 0, "")], SCHEMA))


def test_intervals_against_scanning():
    rng = np.random.default_rng(0)
    for n in (2, 3, 7, 64, 65):
        lcp = rng.integers(0, 4, n - 1)
        table = prefixtrie.sparse(lcp)
        at, depth = rng.integers(0, n, 200), rng.integers(0, 5, 200)
        left, right = prefixtrie.extents(table, at, depth)
        for a, d, lo, hi in zip(at, depth, left, right):
            x, y = a, a
            while x > 0 and lcp[x - 1] >= d:
                x -= 1
            while y < n - 1 and lcp[y] >= d:
                y += 1
            assert (lo, hi) == (x, y)
        values = rng.integers(-9, 9, n)
        lo, hi = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
        assert (prefixtrie.least(prefixtrie.sparse(values), lo, hi) == [values[a:b + 1].min() for a, b in zip(lo, hi)]).all()
