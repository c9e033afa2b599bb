"""The manifest against a plain recursive tree, on rows with every edge case."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractlake.llm import merkle

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, idx int, tree string, total int"


def brute_tree(leaves):
    """(root, proof of each leaf) by lists of lists."""
    proofs, groups, level = [""] * len(leaves), [[i] for i in range(len(leaves))], leaves
    while len(level) > 1:
        up, merged = [], []
        for a in range(0, len(level), 16):
            run = level[a:a + 16]
            for k in range(len(run)):
                for leaf in groups[a + k]:
                    proofs[leaf] += "".join(run[:k] + run[k + 1:])
            up.append(H(*run))
            merged.append([x for g in groups[a:a + 16] for x in g])
        level, groups = up, merged
    return level[0], proofs


def spelt(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r):
    return H(*(spelt(r[i]) for i in (0, 3, 2, 4, 1)))


def brute(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[3]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        made[s] = brute_tree([leaf_of(r) for r in trees[s]])
    root, tops = brute_tree([made[s][0] for s in names])
    return collections.Counter((r[0], leaf_of(r), made[s][0], root, H(p + top))
                               for s, top in zip(names, tops) for r, p in zip(trees[s], made[s][1]))


def make(n, sources, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", "Some Text é", "x" * 9000]), rng.choice(["en", None]), rng.choice(sources),
             rng.choice([None, 5]), 1, "clash", 2) for i in range(n)]
    return rows + [rows[0], rows[0], (None, "null key", "en", sources[0], 1, None, None, None)] * (n > 1)


@pytest.mark.parametrize("levels", range(1, 6))
def test_layout_holds_every_node_once(levels):
    at = [merkle.places(levels, d, np.arange(16 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(merkle.full(levels)))
    top = levels // 2
    if top:  # the top half comes first, then whole subtrees side by side
        assert max(a.max() for a in at[:top]) < merkle.full(top)
        low = merkle.full(levels - top)
        for d in range(top, levels):
            assert ((at[d] - merkle.full(top)) // low == np.arange(16 ** d) // 16 ** (d - top)).all()


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096])
def test_block_against_lists(n):
    leaves = [H(str(i)) for i in range(n)]
    block = merkle.Block.of_leaves(np.frombuffer(bytes.fromhex("".join(leaves)), "V32"), merkle.height_of(n))
    root, proofs = brute_tree(leaves)
    assert block.root().hex() == root
    again = merkle.Block(n, block.height, block.nodes)
    for i, (leaf, path) in enumerate(again.paths()):
        assert leaf.hex() == leaves[i] and merkle.siblings(path) == proofs[i]
        if i % 97 == 0:
            assert merkle.fold(leaf, path).hex() == root
            assert n == 1 or merkle.fold(bytes(32), path).hex() != root


@pytest.mark.parametrize("height, n, sources", [
    (1, 700, ["a", None, "é", "B", ""]),  # blocks of 16 leaves, three stages, trees of several heights
    (2, 700, ["a", "a", "a", "b"]), (3, 90, [f"s{i}" for i in range(40)]), (1, 60, [f"s{i}" for i in range(40)] + [None]),
    (1, 1, ["only"]), (1, 40, ["only"])])
def test_manifest_against_brute_force(spark, monkeypatch, height, n, sources):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = make(n, sources)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    other = merkle.leaf_digest(*[docs[c] for c in ("doc_id", "source", "lang", "n_chars")], F.lit("forged"))
    m = merkle.manifest(docs, shown=F.when(docs["doc_id"] % 7 == 3, other))
    got = merkle.check(m).collect()
    assert collections.Counter((r.key, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == brute(rows)
    assert all((r.folded_root == r.root) == r.verified == (r.key is None or r.key % 7 != 3) for r in got)
    assert m.root() == got[0].root
    assert all(merkle.fold(bytes(r.leaf), bytes(r.path)) == bytes(r.root) for r in merkle.proofs(m).collect())


def test_empty_table(spark):
    m = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert m.root() is None and merkle.check(m).collect() == []


def test_any_change_changes_the_root(spark):
    rows = make(50, ["a", "b"])
    root = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).root()
    assert merkle.manifest(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).root() == root
    for i, v in ((1, "other"), (2, "zz"), (3, "b2"), (4, 6)):
        changed = [(*rows[9][:i], v, *rows[9][i + 1:]) if j == 9 else r for j, r in enumerate(rows)]
        assert merkle.manifest(spark.createDataFrame(changed, SCHEMA)).root() != root
