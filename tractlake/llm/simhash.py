"""SimHash near-dedup with BK-trees.

1. A text's fingerprint has bit b set if b is set in over half of the 64-bit hashes of
   its word shingles, repeats included.
2. Distinct fingerprints are dealt to shards. The 64 bits are cut into two parts more than the
   radius (at least four), so two equal parts are left wherever at most ``radius`` bits
   differ: each fingerprint goes to the shards of all its pairs of parts (six for radius 2,
   ten for 3) and meets every partner in one of them. Pairs of parts that only one
   fingerprint has need no search. A pair shared by more than ``HOT`` fingerprints is dealt
   once more, by the pairs of parts of its other bits; then 48 bits agree at radius 2 and 41
   at 3, so no bucket can pass 65,536 or 8 million fingerprints. Buckets are packed into
   shards by hash.
3. Each shard becomes a BK-tree: the children of a node are keyed by their integer Hamming
   distance to it. The trees (13 bytes a fingerprint, in proportion bounded by the above)
   meet the shard's fingerprints in a join: Spark broadcasts the table of trees where its
   size is below the session's threshold and deals both sides by shard where it isn't.
   A search goes from a node at distance d only into edges from d - radius to d + radius.
4. A task returns, of the links that it found, a forest with the same components. Stars
   (large, then small) join the forests until nothing changes, each round written to the
   shared folder; fingerprints and links never reach the driver.

A radius above 3 is refused: a bucket, which is one task's tree, would have no useful bound.

Defined cases: null or empty text, or one without a word, has fingerprint zero, which
links like any other; a text shorter than the shingle is one shingle; repeated rows share
fingerprint and component; a null key takes part but never names a component unless all
keys of it are null (component null); an empty table gives an empty result; further
columns pass through ``keep_one`` unchanged and can't clash.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tractlake.llm.common import small_batches, words_of, written

SHINGLE = 3
RADIUS = 2
MOST_RADIUS = 3
HOT = 4096
SHARD_NODES = 2048
QUERY_PARTS = 16
PAIRS_AT_ONCE = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of each shingle of words, as signed longs."""
    w = words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER))
    join = lambda x: F.xxhash64(F.array_join(x, " "))

    def of(x):
        several = F.transform(F.sequence(F.lit(1), F.size(x) - (shingle - 1)),
                              lambda i: join(F.slice(x, i, shingle)))
        return F.when(F.size(x) >= shingle, several).when(F.size(x) > 0, F.array(join(x))).otherwise(
            F.array().cast("array<bigint>"))
    return F.transform(F.array(w), of)[0]


def majority(hashes: np.ndarray, offsets: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    """Fingerprints (uint64) of documents whose hashes lie at offsets[i]:offsets[i + 1]."""
    counts = np.zeros((len(offsets) - 1, 64), np.int64)
    for a in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[a:a + step]).view(np.uint8).reshape(-1, 8)
        b = a + len(part)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        first = np.searchsorted(offsets, a, "right") - 1
        last = np.searchsorted(offsets, b, "left")
        start = np.maximum(offsets[first:last], a) - a
        end = np.minimum(offsets[first + 1:last + 1], b) - a
        full = np.flatnonzero(end > start)
        counts[first + full] += np.add.reduceat(bits, start[full], axis=0, dtype=np.int64)
    over = 2 * counts > np.diff(offsets)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _add_fingerprint(batches):
    for batch in batches:
        hashes = batch.column(0)
        offsets = hashes.offsets.to_numpy().astype(np.int64)
        flat = hashes.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
        fps = majority(flat, offsets - offsets[0]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(fps), *batch.columns[1:]], ["fp", *batch.schema.names[1:]])


def fingerprints(docs: DataFrame, text: Column, shingle: int = SHINGLE, **others: Column) -> DataFrame:
    """fp, the 64-bit SimHash of ``text`` as a signed long, and the named columns."""
    df = docs.select(shingle_hashes(text, shingle).alias("hashes"), *[c.alias(n) for n, c in others.items()])
    schema = T.StructType([T.StructField("fp", T.LongType()), *df.schema.fields[1:]])
    return df.mapInArrow(_add_fingerprint, schema)


# --- BK-tree -----------------------------------------------------------------------------

class BKTree:
    """Nodes in breadth-first order: the children of node i are child[i]:child[i + 1], each
    with its distance to i as ``edge``."""

    def __init__(self, fps: np.ndarray, edge: np.ndarray, child: np.ndarray):
        self.fps, self.edge, self.child = fps, edge, child

    @classmethod
    def build(cls, fps: np.ndarray) -> BKTree:
        """The tree that inserting the distinct ``fps`` in ascending order would give: what is
        at distance d from a node goes below its child d, the first of them being that child."""
        rest = [np.unique(fps.astype(np.uint64))]
        out, edge, child = [], [0], []
        for i in itertools.count():
            if i == len(rest) or not len(rest[i]):
                break
            top, below = rest[i][0], rest[i][1:]
            rest[i] = rest[i][:1]
            out.append(top)
            child.append(len(rest))
            d = np.bitwise_count(below ^ top)
            order = np.argsort(d, kind="stable")
            cuts = np.flatnonzero(np.diff(d[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                rest.append(below[part])
                edge.append(int(d[part[0]]))
        child.append(len(rest))
        n = len(out)
        return cls(np.array(out, np.uint64), np.array(edge[:n], np.uint8), np.array(child, np.int32))

    def pack(self) -> bytes:
        return self.fps.tobytes() + self.child.tobytes() + self.edge.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> BKTree:
        n = (len(data) - 4) // 13
        return cls(np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint8, n, 12 * n + 4),
                   np.frombuffer(data, np.int32, n + 1, 8 * n))

    def search(self, queries: np.ndarray, radius: int):
        """Yields arrays (query number, node number) of pairs at most ``radius`` apart. All
        queries go down together, ``PAIRS_AT_ONCE`` (query, node) pairs at a time."""
        if not len(self.fps):
            return
        todo = [(np.arange(len(queries)), np.zeros(len(queries), np.int64))]
        while todo:
            q, node = todo.pop()
            if len(q) > PAIRS_AT_ONCE:
                todo += [(q[PAIRS_AT_ONCE:], node[PAIRS_AT_ONCE:])]
                q, node = q[:PAIRS_AT_ONCE], node[:PAIRS_AT_ONCE]
            d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int16)
            near = d <= radius
            yield q[near], node[near]
            start, many = self.child[node].astype(np.int64), self.child[node + 1] - self.child[node]
            pair = np.repeat(np.arange(len(q)), many)
            below = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + start[pair]
            follow = np.abs(self.edge[below].astype(np.int16) - d[pair]) <= radius
            if follow.any():
                todo.append((q[pair[follow]], below[follow]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (v, smallest of v's component), v larger, that join what the links (a, b) join."""
    names, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[:len(a)], code[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    up = np.flatnonzero(label != np.arange(len(names)))
    return names[up], names[label[up]]


# --- Shards, search and components on Spark -----------------------------------------------

def _pairs(value: Column, bits: int, parts: int) -> tuple[Column, int]:
    """Array of (pair, key, other): each pair of the ``parts`` parts of the low ``bits`` bits, its
    bits and those of the other parts; and the number of bits that the others have at most."""
    width = [bits // parts + (i < bits % parts) for i in range(parts)]
    part = [F.shiftrightunsigned(value, sum(width[:i])).bitwiseAND(F.lit((1 << width[i]) - 1).cast("bigint"))
            for i in range(parts)]

    def side_by_side(which):
        return functools.reduce(lambda x, i: F.shiftleft(x, width[i]) + part[i], which[1:], part[which[0]])
    pairs = list(itertools.combinations(range(parts), 2))
    others = [[i for i in range(parts) if i not in pair] for pair in pairs]
    return F.array(*[F.struct(F.lit(n).alias("pair"), side_by_side(pair).alias("key"), side_by_side(rest).alias("other"))
                     for n, (pair, rest) in enumerate(zip(pairs, others))]), bits - sum(sorted(width)[:2])


def shards(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """shard, fp: each distinct fingerprint in every shard where a partner may be."""
    spark, parts = fps.sparkSession, max(radius + 2, 4)
    pairs, left = _pairs(F.col("fp"), 64, parts)
    keyed = fps.select("fp", F.explode(pairs).alias("p")).select("fp", "p.*")
    many = written(keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-keys")
    shared = written(keyed.join(many, ["pair", "key"]), "simhash-shared")
    plain = shared.filter(F.col("n") <= HOT).select("fp", F.xxhash64("pair", "key").alias("bucket"))
    finer = (shared.filter(F.col("n") > HOT)
             .select("fp", "pair", "key", F.explode(_pairs(F.col("other"), left, parts)[0]).alias("s"))
             .select("fp", F.xxhash64("pair", "key", "s.pair", "s.key").alias("bucket")))
    both = plain.unionByName(finer)
    size = both.count() // SHARD_NODES + 1
    out = both.select(F.pmod("bucket", F.lit(size)).alias("shard"), "fp").distinct()
    return written(out.repartition(max(size // 4 + 1, spark.sparkContext.defaultParallelism), "shard"), "simhash-shards")


def _tree_of(key, rows):
    import pandas as pd
    tree = BKTree.build(rows["fp"].to_numpy().view(np.uint64))
    return pd.DataFrame({"shard": [key[0]], "tree": [tree.pack()]})


def _search(radius: int):
    def run(batches):
        import pandas as pd
        for batch in batches:
            for queries, data in zip(batch["fps"], batch["tree"]):
                tree, q = BKTree.unpack(data), np.array(queries, np.int64).view(np.uint64)
                v = m = np.empty(0, np.uint64)
                for i, node in tree.search(q, radius):
                    a, b = q[i], tree.fps[node]
                    v, m = forest(np.concatenate([v, a[a != b]]), np.concatenate([m, b[a != b]]))
                yield pd.DataFrame({"v": v.view(np.int64), "m": m.view(np.int64)})
    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """v, m: links between distinct fingerprints with the components of all links."""
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"buckets are bounded for a radius from 0 to {MOST_RADIUS}")
    placed = shards(fps, radius)
    trees = written(placed.groupBy("shard").applyInPandas(_tree_of, "shard long, tree binary"), "simhash-trees")
    queries = (placed.groupBy("shard", F.pmod(F.xxhash64("fp"), F.lit(QUERY_PARTS)).alias("part"))
               .agg(F.collect_list("fp").alias("fps")))
    found = queries.join(trees, "shard").select("fps", "tree").mapInPandas(_search(radius), "v long, m long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """v, root: for each vertex of ``edges`` (v, m) the smallest vertex of its component."""
    e = written(edges.filter("v <> m").select(F.greatest("v", "m").alias("v"), F.least("v", "m").alias("m"))
                .distinct(), "components")
    before = None
    while True:
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = e.unionByName(e.select(F.col("m").alias("v"), F.col("v").alias("m")))
        low = both.groupBy("v").agg(F.least(F.min("m"), F.first("v")).alias("low"))
        large = (both.join(low, "v").filter("m > v").select(F.col("m").alias("v"), F.col("low").alias("m"))
                 .filter("v <> m").distinct())
        large = written(large, "components")
        # Small star: the smaller neighbours of u, and u, are linked to the smallest of them.
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = (large.join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m"))
                 .unionByName(low.select("v", F.col("low").alias("m"))).filter("v <> m").distinct())
        e = written(small, "components")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select("v", F.col("m").alias("root"))
        before = now


def near_duplicates(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``rows`` (key, fp and any others) with ``root`` (the component's smallest fingerprint)
    and ``component`` (its smallest key)."""
    fps = written(rows.groupBy("fp").agg(F.min("key").alias("low")), "simhash-distinct")
    found = components(links(fps.select("fp"), radius)).withColumnRenamed("v", "fp")
    placed = fps.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("low").alias("component"))
    classes = written(placed.select("fp", "root").join(named, "root"), "simhash-classes")
    return rows.join(classes, "fp")


def _fingerprinted(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    rows = fingerprints(docs, docs[text], shingle, key=docs[key], text_hash=F.xxhash64(docs[text]))
    with small_batches(docs.sparkSession):
        return written(rows, "simhash")


def simhash_dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS) -> DataFrame:
    """key, fp, text_hash, root, component: one row per document."""
    return near_duplicates(_fingerprinted(docs, key, text, shingle), radius)


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """The document with the smallest key of each component, with its columns. Of several
    texts under that key the one with the smallest hash stays; rows that repeat key and text
    are one document and stay together."""
    found = simhash_dedup(docs, key=key, text=text, shingle=shingle, radius=radius)
    stays = (found.filter(F.col("key").eqNullSafe(F.col("component"))).groupBy("root")
             .agg(F.min(F.struct("text_hash", "key")).alias("s")).select("s.*"))
    stays = written(stays, "simhash-stays")
    return docs.join(stays, docs[key].eqNullSafe(stays["key"])
                     & (F.xxhash64(docs[text]) == stays["text_hash"]), "left_semi")
