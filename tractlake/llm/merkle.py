"""Merkle manifest of a dataset: 16-ary hash trees in van Emde Boas layout.

Each tree (a source) has its rows' digests as leaves, in order; every 16 consecutive nodes
(the last run may be shorter) become the digest of their hex digests, until one remains, the
subroot. The subroots, ordered by tree, are the leaves of one more tree, whose top is the root.

Trees are stored as blocks: aligned subtrees of up to 16 ** ``HEIGHT`` leaves. The roots of a
stage's blocks are the leaves of the next stage's, so construction recurses over block roots
and a task holds a block at a time, however large a tree is. Inside a block the nodes lie in
van Emde Boas order: a tree of n levels is cut at half height, its top is laid out first,
then the trees below the cut one after the other, each in the same way. ``places`` computes
the address of any node from its depth and number alone; building, looking siblings up and
folding use nothing else, at any block size.

Proofs go from the top down: a block that knows the path above its root gives each of its
leaves their path, which the blocks of the stage below start from.

Defined cases: null fields enter a leaf as ``-``; a null tree comes first; a null key comes first in its tree;
repeated rows are leaves of their own, rows of one key are ordered by their digest; a tree of one leaf has
it as subroot, and a dataset of one tree has that as root; an empty table gives no row and
no root. Columns besides those named are neither read nor able to clash.
"""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tractlake.llm.common import numbered, runs, written

FAN = 16
HEIGHT = 3  # of a block: up to 4,096 leaves, about 200 KB
DIGEST = 32
FLUSH = 1 << 22


# --- A block ------------------------------------------------------------------------------

def full(levels: int) -> int:
    """Nodes of a complete tree."""
    return (FAN ** levels - 1) // (FAN - 1)


def places(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Addresses of nodes of one depth (0: the root) in the layout of a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(number)
    top = levels // 2
    if depth < top:
        return places(top, depth, number)
    tree, inside = np.divmod(number, FAN ** (depth - top))
    return full(top) + tree * full(levels - top) + places(levels - top, depth - top, inside)


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    h = 0
    while FAN ** h < n:
        h += 1
    return h


class Block:
    """The nodes of an aligned subtree of ``n`` leaves and ``height`` levels above them."""

    def __init__(self, n: int, height: int, nodes: np.ndarray | None = None):
        self.n, self.height = n, height
        size = 1 + max(int(self._at(d)[-1]) for d in range(height + 1))
        self.nodes = np.zeros(size, f"V{DIGEST}") if nodes is None else nodes

    @classmethod
    def of_leaves(cls, leaves: np.ndarray, height: int) -> Block:
        block = cls(len(leaves), height)
        block.nodes[block._at(height)] = leaves
        for depth in range(height - 1, -1, -1):
            runs_ = [hashlib.sha256(r.hex().encode()).digest() for r in block.level_runs(depth + 1)]
            block.nodes[block._at(depth)] = np.frombuffer(b"".join(runs_), block.nodes.dtype)
        return block

    def _at(self, depth: int) -> np.ndarray:
        return places(self.height + 1, depth, np.arange(-(-self.n // FAN ** (self.height - depth))))

    def level_runs(self, depth: int) -> list[bytes]:
        """The digests of the nodes of a depth, 16 consecutive ones joined."""
        data, step = self.nodes[self._at(depth)].tobytes(), FAN * DIGEST
        return [data[a:a + step] for a in range(0, len(data), step)]

    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def paths(self, above: bytes = b""):
        """(leaf, path) of each leaf. A path is, level by level and from the leaf up, the
        place in the run, the run's length and the run's digests; ``above`` is the root's."""
        known = [above]
        for depth in range(1, self.height + 1):
            last = depth == self.height
            made = (self._step(r, k, known[i])
                    for i, r in enumerate(self.level_runs(depth)) for k in range(len(r) // DIGEST))
            if last:
                leaf = self.nodes[self._at(depth)].tobytes()
                yield from ((leaf[DIGEST * i:DIGEST * (i + 1)], p) for i, p in enumerate(made))
                return
            known = list(made)
        yield self.root(), above

    @staticmethod
    def _step(run: bytes, k: int, above: bytes) -> bytes:
        return bytes((k, len(run) // DIGEST)) + run + above


def _steps(path: bytes):
    at = 0
    while at < len(path):
        k, n = path[at], path[at + 1]
        yield k, path[at + 2:at + 2 + n * DIGEST]
        at += 2 + n * DIGEST


def siblings(path: bytes) -> str:
    """Hex digests of the siblings on a path, from the leaf up, left to right."""
    return "".join((run[:DIGEST * k] + run[DIGEST * (k + 1):]).hex() for k, run in _steps(path))


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` and the siblings on its path give."""
    for k, run in _steps(path):
        mended = run[:DIGEST * k] + leaf + run[DIGEST * (k + 1):]
        leaf = hashlib.sha256(mended.hex().encode()).digest()
    return leaf


# --- Stages on Spark ------------------------------------------------------------------------

STAGE = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("height", pa.int32()),
                   ("nodes", pa.binary()), ("root", pa.binary())])
STAGE_SQL = "tree string, block bigint, n int, height int, nodes binary, root binary"


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), f"V{DIGEST}")


def _batches(rows, schema: pa.Schema, weight):
    """Record batches of about ``FLUSH`` bytes from tuples."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _stage(leaves: DataFrame, name: str, extra: list[str]) -> DataFrame:
    """Blocks of leaves (tree, idx, total, digest and the ``extra`` columns, which become lists)."""
    span = FAN ** HEIGHT
    kinds = {c: leaves.schema[c].dataType.simpleString() for c in extra}
    rows = leaves.select("tree", F.floor(F.col("idx") / span).cast("long").alias("block"), "idx", "total", "digest", *extra)
    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")

    def run(batches):
        held, size = [], 0

        def flush():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*[h[0] for h in held]), STAGE)]
            for i in range(len(extra)):
                lists = [h[1][i] for h in held]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends, pa.concat_arrays(lists)))
            return pa.RecordBatch.from_arrays(columns, [*STAGE.names, *extra])
        for (tree, block), t in runs(batches, 2):
            total = t.column("total")[0].as_py()
            made = Block.of_leaves(_digests(t.column("digest")), HEIGHT if total > span else height_of(total))
            held.append(((tree, block, made.n, made.height, made.nodes.tobytes(), made.root()),
                         [t.column(c).combine_chunks() for c in extra]))
            size += made.nodes.nbytes + t.nbytes
            if size >= FLUSH:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()
    schema = STAGE_SQL + "".join(f", {c} array<{k}>" for c, k in kinds.items())
    return written(dealt.mapInArrow(run, schema), name)


def _stages(leaves: DataFrame, name: str, extra: list[str]) -> list[DataFrame]:
    """All stages of the trees over numbered leaves, the lowest first."""
    totals = leaves.groupBy("tree").agg(F.count("*").alias("total"))
    out = [_stage(leaves.join(totals, "tree"), f"{name}-0", extra)]
    span = FAN ** HEIGHT
    # The blocks of a tree are numbered without gaps, so the highest number tells how many there are.
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        below = out[-1]
        many = below.groupBy("tree").agg(F.count("*").alias("total")).filter("total > 1")
        roots = below.select("tree", F.col("block").alias("idx"), F.col("root").alias("digest")).join(many, "tree")
        out.append(_stage(roots, f"{name}-{len(out)}", []))
    return out


@dataclasses.dataclass
class Manifest:
    """``trees``: the stages of all trees, the lowest first, with the lists ``key`` and
    ``shown`` in the lowest; ``top``: the stages of the tree over them, with the lists ``key``
    (the tree) and ``last`` (the number of the tree's highest stage) in the lowest."""
    trees: list[DataFrame]
    top: list[DataFrame]
    key_type: str

    def root(self) -> str | None:
        """Hex digest of the whole dataset; None if it is empty."""
        row = self.top[-1].select("root").first()
        return row and bytes(row[0]).hex()


def field(c: Column) -> Column:
    """A value's spelling in a leaf: its size in UTF-8 bytes, a colon and itself, or ``-``."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def manifest(docs: DataFrame, *, key: str = "doc_id", tree: str = "source",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             shown: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``shown``: the leaf of a copy that is to be verified against
    it, null where that is the row's own."""
    name = F.coalesce(F.concat(F.lit("1"), docs[tree].cast("string")), F.lit(""))  # null first, no name lost
    rows = written(docs.select(
        docs[key].alias("key"), name.alias("tree"), leaf_digest(*[docs[c] for c in columns]).alias("digest"),
        (F.lit(None).cast("binary") if shown is None else shown).alias("shown")), "merkle-leaves")
    trees = _stages(numbered(rows, "merkle-order", ["tree"], ["key", "digest"]), "merkle-trees", ["key", "shown"])
    ends = trees[0].filter("block = 0").select("tree", "root", F.lit(0).alias("last"))
    for i, stage in enumerate(trees[1:], 1):  # a subroot is the root of the one block of its tree's last stage
        upper = stage.filter("block = 0").select("tree", F.col("root").alias("upper"))
        ends = ends.join(upper, "tree", "left").select(
            "tree", F.coalesce("upper", "root").alias("root"),
            F.when(F.col("upper").isNull(), F.col("last")).otherwise(F.lit(i)).alias("last"))
    subroots = ends.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"), "last")
    top = _stages(numbered(subroots, "merkle-subroots", ["tree"], ["key"]), "merkle-top", ["key", "last"])
    return Manifest(trees, top, rows.schema["key"].dataType.simpleString())


PATH = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("last", pa.int32()), ("above", pa.binary()),
                  ("subroot", pa.binary()), ("whole", pa.binary())])
PATH_SQL = "tree string, block bigint, last int, above binary, subroot binary, whole binary"


def _joined(stage: DataFrame, above: DataFrame | None, lists: list[str]) -> DataFrame:
    """Blocks with the path above their root; without ``above`` the root is the whole dataset's."""
    if above is None:
        rows = stage.select("*", F.lit(b"").alias("above"), F.lit(None).cast("binary").alias("subroot"),
                            F.col("root").alias("whole"))
    else:
        rows = stage.join(above, ["tree", "block"])
    return rows.select("tree", "block", "n", "height", "nodes", "above", "subroot", "whole", *lists)


def _leaves(batches):
    """(tree, number in the tree, leaf, path, subroot, whole, lists' values) of each leaf."""
    for batch in batches:
        for i in range(batch.num_rows):
            tree, number, n, height, nodes, above, subroot, whole, *lists = (c[i].as_py() for c in batch.columns)
            block = Block(n, height, np.frombuffer(nodes, f"V{DIGEST}"))
            for j, (leaf, path) in enumerate(block.paths(above)):
                yield tree, number * FAN ** HEIGHT + j, leaf, path, subroot, whole, [x[j] for x in lists]


def _paths(stages: list[DataFrame], name: str, tops: DataFrame | None, lists: list[str]) -> DataFrame:
    """The lowest stage with the paths above its blocks. ``tops`` holds those of whole trees."""
    def down(batches):
        made = ((tree, number, None, path, subroot, whole) for tree, number, _, path, subroot, whole, _ in _leaves(batches))
        yield from _batches(made, PATH, lambda x: len(x[3]) + 100)
    above = None
    for i in range(len(stages) - 1, 0, -1):
        here = tops and tops.filter(F.col("last") == i).drop("last")
        if here is not None and above is not None:
            here = here.unionByName(above)
        rows = _joined(stages[i], here if here is not None else above, [])
        above = written(rows.mapInArrow(down, PATH_SQL), f"{name}-{i}").drop("last")
    here = tops and tops.filter("last = 0").drop("last")
    if here is not None and above is not None:
        here = here.unionByName(above)
    return _joined(stages[0], here if here is not None else above, lists)


def _rows(m: Manifest, columns: pa.Schema, sql: str, row, lists: list[str]) -> DataFrame:
    def down(batches):
        made = ((x[0], 0, x[1], path, leaf, whole) for _, _, leaf, path, _, whole, x in _leaves(batches))
        yield from _batches(made, PATH, lambda x: len(x[3]) + 100)
    tops = written(_paths(m.top, "merkle-top-paths", None, ["key", "last"]).mapInArrow(down, PATH_SQL), "merkle-tree-paths")

    def run(batches):
        for first in batches:  # the key's type is the list's
            schema = pa.schema([pa.field("key", first.column(8).type.value_type), *columns])
            made = ((x[0], *row(leaf, path, subroot, whole, *x[1:])) for _, _, leaf, path, subroot, whole, x in _leaves([first]))
            yield from _batches(made, schema, lambda x: sum(len(v) if isinstance(v, (bytes, str)) else 8 for v in x))
    return _paths(m.trees, "merkle-paths", tops, lists).mapInArrow(run, f"key {m.key_type}, {sql}")


def proofs(m: Manifest) -> DataFrame:
    """key, leaf, path (see ``Block.paths``), subroot and root of every row."""
    def row(leaf, path, subroot, whole):
        return leaf, path, subroot, whole
    columns = pa.schema([(c, pa.binary()) for c in ("leaf", "path", "subroot", "root")])
    return _rows(m, columns, "leaf binary, path binary, subroot binary, root binary", row, ["key"])


def check(m: Manifest) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256 (of the siblings' hex digests along the path),
    folded_root (from the leaf shown, or else the row's own) and verified, digests as hex."""
    def row(leaf, path, subroot, whole, shown):
        folded = fold(leaf if shown is None else shown, path)
        return (leaf.hex(), subroot.hex(), whole.hex(), hashlib.sha256(siblings(path).encode()).hexdigest(),
                folded.hex(), folded == whole)
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    columns = pa.schema([*[(c, pa.string()) for c in names], ("verified", pa.bool_())])
    return _rows(m, columns, ", ".join(f"{c} string" for c in names) + ", verified boolean", row, ["key", "shown"])
