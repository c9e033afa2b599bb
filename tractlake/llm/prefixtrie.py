"""Prefix trie of conversations: member intervals over sorted LCPs.

A node is a distinct sequence of first turns. A turn is known by 16 bytes of the SHA-256 of
its role and text and by the size of its text; texts are not moved. Turns are numbered per
conversation over sorted ranges (``numbered``), so no conversation is brought together.

Depths are worked on in bands of ``BAND`` turns. In a band, conversations with equal turns
there and equal turns before fold into one key; keys are dealt by ranges of their order,
sorted, and each shard is worked on alone:
* the longest common prefix (LCP) of neighbours, the shard before the first key included;
* sparse tables of range minima over the LCPs and over the smallest members;
* every prefix that a key introduces, and its parent, finds its interval of keys by two
  binary searches, to the left and to the right, over the LCP table. No candidate needs
  another one's result, and there is no stack;
* members, children, leaves and bytes of the interval are differences of running sums.
A prefix whose interval reaches over a shard's edge gives a part of its row in each shard;
the parts are added up. There are at most two times ``BAND`` + 1 such a shard.

Keys that two or more conversations continue are the groups of the next band; what a group
adds to its subtree comes back from there, the deepest band first. A conversation that goes
on alone is a chain, whose rows need no search. So the number of bands is that of the
longest shared beginning.

The digest of a node's ended members is sequential: their sorted numbers stream through one task
a key, which holds the hash's state and nothing else.

Defined cases: turns are ordered by turn (null first), then role, then digest of the text; a null role or
text is empty; repeated turns count as often as they occur; rows without a conversation
belong to none; a conversation without turns ends at the root; without any conversation
there is no row. Columns besides those named are neither read nor able to clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tractlake.llm.common import numbered, written
from tractlake.operators.skew import salted_lookup_join

BAND = 64
SHARD_KEYS = 1 << 15
HEAD = 8  # turns that a rebuilt conversation takes from another, at most
TOKEN = 16
NOTHING = hashlib.sha256(b"").hexdigest()
NO_TOP = -2 ** 63  # for null, in arrays


# --- Rebuilt conversations -----------------------------------------------------------------

def turns_of(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, idx (from 0), token (hex) and bytes of each turn."""
    r, t = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in (role, text))
    token = F.substring(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * TOKEN)
    turns = rows.filter(rows[conv].isNotNull()).select(
        rows[conv].cast("long").alias("conv"), rows[turn].alias("turn"), r.alias("role"), token.alias("token"),
        F.octet_length(t).cast("long").alias("bytes"))
    return numbered(turns, "trie-turns", ["conv"], ["turn", "role", "token"]).select("conv", "idx", "token", "bytes")


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """(conv, n) and (conv, depth, token, bytes) of conversations that start with the first
    ``head`` turns (at most ``HEAD``) of the conversation ``base``, then go on with their own
    after as many. ``base`` and ``head`` are expressions of conv."""
    convs = written(turns.groupBy("conv").agg(F.count("*").alias("own")), "trie-conversations")
    starts = (turns.filter(F.col("idx") < HEAD).groupBy("conv")
              .agg(F.sort_array(F.collect_list(F.struct("idx", "token", "bytes"))).alias("start")))  # at most HEAD
    plan = convs.select("conv", "own", base.alias("base"), head.cast("long").alias("head"))
    plan = plan.join(starts.withColumnRenamed("conv", "base"), "base", "left").select(
        "conv", "own", "head", F.slice(F.coalesce("start", F.array().cast(starts.schema["start"].dataType)),
                                       1, F.col("head").cast("int")).alias("start"))
    plan = plan.withColumn("short", F.col("head") - F.size("start"))
    n = F.size("start") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    first = plan.select("conv", F.explode("start").alias("t")).select(
        "conv", (F.col("t.idx") + 1).alias("depth"), "t.token", "t.bytes")
    # Only where the other conversation is short or absent do own turns move up.
    moved = salted_lookup_join(turns.withColumn("head", head.cast("long")).filter("idx >= head"),
                               plan.filter("short > 0").select("conv", "short"), ["conv"], how="left", salt_on=["idx"])
    own = moved.select("conv", (F.col("idx") + 1 - F.coalesce("short", F.lit(0))).alias("depth"), "token", "bytes")
    return plan.select("conv", n.alias("n")), first.unionByName(own)


# --- Keys of a band --------------------------------------------------------------------------

FOLDED = "key binary, conv bigint, members bigint, ended bigint, ends string, going bigint"


def _fold(batches):
    """A row a key from (key, conv, more) in order: smallest conv, members, ended ones, the
    digest of their numbers, and those that go on."""
    key, row, sha = None, None, None

    def close():
        return [key, row[0], row[1], row[2], sha.hexdigest(), row[1] - row[2]]
    for batch in batches:
        done, (keys, convs, more) = [], (c.to_pylist() for c in batch.columns)
        for k, c, m in zip(keys, convs, more):
            if k != key:
                if row:
                    done.append(close())
                key, row, sha = k, [c, 0, 0], hashlib.sha256()
            row[1] += 1
            if not m:
                sha.update(b"," * (row[2] > 0) + b"%d" % c)
                row[2] += 1
        if done:
            yield _folded(done)
    if row:
        yield _folded([close()])


def _folded(rows):
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      ["key", "conv", "members", "ended", "ends", "going"])


def _keys(alive: DataFrame, turns: DataFrame, band: int) -> tuple[DataFrame, DataFrame]:
    """(conversations, keys) of a band, from (conv, n, group, top): the group's digest and the
    smallest conversation of its node."""
    low, high = band * BAND, (band + 1) * BAND
    here = turns.filter((F.col("depth") > low) & (F.col("depth") <= high)).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "token", "bytes"))).alias("t"))  # at most BAND
    rows = alive.join(here, "conv", "left").select(
        "conv", "n", "group", "top",
        F.coalesce(F.unhex(F.array_join("t.token", "")), F.lit(b"")).alias("tokens"),
        F.coalesce("t.bytes", F.array().cast("array<bigint>")).alias("sizes"), (F.col("n") > high).alias("more"))
    rows = written(rows.withColumn("key", F.unhex(F.sha2(F.concat("group", "tokens"), 256))), f"trie-band-{band}")
    folded = (rows.select("key", "conv", "more").repartition("key").sortWithinPartitions("key", "conv")
              .mapInArrow(_fold, FOLDED))
    return rows, written(folded.join(rows.select("conv", "group", "top", "tokens", "sizes"), "conv"), f"trie-keys-{band}")


# --- A shard ---------------------------------------------------------------------------------

def common(a: tuple, b: tuple) -> int:
    """Levels that two keys (group, tokens) share; the group is the first."""
    if a is None or b is None or a[0] != b[0]:
        return 0
    x, y = a[1], b[1]
    low, high = 0, min(len(x), len(y)) // TOKEN
    while low < high:
        mid = (low + high + 1) // 2
        if x[low * TOKEN:mid * TOKEN] == y[low * TOKEN:mid * TOKEN]:
            low = mid
        else:
            high = mid - 1
    return 1 + low


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all ranges whose length is a power of two."""
    out = [values]
    while 2 ** len(out) <= len(values):
        half = 2 ** (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum of each range, both ends included."""
    power = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for k in np.unique(power).tolist():
        at = power == k
        out[at] = np.minimum(table[k][left[at]], table[k][right[at] - 2 ** k + 1])
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last key that share ``depth`` levels with key ``at``. ``table[0][i]`` is
    the LCP of keys i and i + 1. Each search narrows by the largest power of two that fits."""
    n = len(table[0]) + 1
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 2 ** k
        near = np.minimum(right, n - 1 - step)
        right += step * ((right + step < n) & (table[k][np.maximum(near, 0)] >= depth))
        near = np.maximum(left - step, 0)
        left -= step * ((left - step >= 0) & (table[k][near] >= depth))
    return left, right


def shard_rows(keys: list[tuple], sizes: list[list], members, ended, conv, going, leaves, saved, children,
               top, ends, before: tuple | None, after: tuple | None) -> dict:
    """Columns of the nodes and parts of nodes in a shard of sorted keys.

    A row has its key's number and level (1: the group), its measures as far as they lie in the
    shard, ``edge`` (which prefix at the shard's edge it is, or -1), ``fresh`` (no shard before has
    it), and its parent's smallest conversation or, where that prefix is at the edge, its edge.
    """
    n = len(keys)
    members, ended, conv, going, leaves, saved, children, top = (
        np.asarray(x, np.int64) for x in (members, ended, conv, going, leaves, saved, children, top))
    length = np.array([1 + len(k[1]) // TOKEN for k in keys], np.int64)
    lcp = np.array([common(a, b) for a, b in zip([before, *keys], keys)], np.int64)
    beyond = common(keys[-1], after)
    # Bytes of a key's first levels: upto[start[i] + e] for e levels.
    start = np.cumsum(length + 1) - (length + 1)
    upto = np.concatenate([np.cumsum([0, 0, *s]) for s in sizes]).astype(np.int64)
    total = upto[start + length]
    table, low = sparse(lcp[1:]) if n > 1 else [], sparse(conv)
    # Candidates: prefixes that a key introduces, and those that come from the shard before.
    count = length - lcp
    at = np.repeat(np.arange(n), count)
    level = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + lcp[at] + 1
    at = np.concatenate([np.zeros(lcp[0], np.int64), at])
    level = np.concatenate([np.arange(1, lcp[0] + 1), level])
    fresh = np.arange(len(at)) >= lcp[0]

    def interval(depth):
        a, b = extents(table, at, depth) if n > 1 else (at.copy(), at.copy())
        carried, open_ = (a == 0) & (depth <= lcp[0]), (b == n - 1) & (depth <= beyond)
        edge = np.where(carried, depth, np.where(open_, BAND + 1 + depth, -1))
        return a, b, np.where(depth > 0, edge, -1)
    left, right, edge = interval(level)
    up_left, up_right, up_edge = interval(level - 1)
    run = lambda x: np.concatenate([[0], np.cumsum(x)])
    over = lambda c: c[right + 1] - c[left]
    extended = np.append(lcp[1:], beyond) >= length
    is_leaf = np.where(going > 0, leaves, ~extended)
    new = total - upto[start + np.minimum(lcp, length)]
    head = upto[start[left] + level - 1]
    n_members = over(run(members))
    # What the members hold from this depth on, less what the nodes hold once.
    held = over(run(members * total)) - n_members * head
    once = np.where(fresh, total[left] - head, new[left]) + run(new)[right + 1] - run(new)[left + 1]
    # A child begins at each key whose LCP is the node's depth, and at the node's own key.
    order = np.lexsort((np.arange(n), lcp))
    code = lcp[order] * (n + 1) + order
    first = np.where(fresh, left + 1, left)
    kids = np.searchsorted(code, level * (n + 1) + right, "right") - np.searchsorted(code, level * (n + 1) + first)
    own = fresh & (length[at] > level)
    full = fresh & (length[at] == level)
    kids = kids + own + np.where(full & (going[at] > 0), children[at], 0)
    return {"at": at, "level": level, "conv": least(low, left, right), "members": n_members, "children": kids,
            "leaves": over(run(is_leaf)), "saved": held - once + over(run(saved)), "edge": edge, "fresh": fresh,
            "parent": np.where((level == 2) & (top[at] != NO_TOP), top[at], least(low, up_left, up_right)),
            "parent_edge": np.where((level == 2) & (top[at] != NO_TOP), -1, up_edge),
            "ends": [ends[i] if f and ended[i] else None for i, f in zip(at.tolist(), full.tolist())]}


SHARD = ("shard int, level int, edge int, fresh boolean, group binary, prefix binary, conv bigint, parent bigint, "
         "parent_edge int, members bigint, children bigint, leaves bigint, saved bigint, ends string")


def _shard(key, rows: pa.Table, bounds: pa.Table) -> pa.Table:
    column = lambda c: rows.column(c).to_pylist()
    keys = list(zip(column("group"), column("tokens")))
    order = sorted(range(len(keys)), key=keys.__getitem__)
    taken = lambda c: [x[i] for x in (column(c),) for i in order]
    near = [b and (b["group"], b["tokens"]) for b in (bounds.column(c)[0].as_py() for c in ("before", "after"))]
    top = [NO_TOP if t is None else t for t in taken("top")]
    keys = [keys[i] for i in order]
    made = shard_rows(keys, taken("sizes"), *map(taken, ("members", "ended", "conv", "going", "leaves", "saved", "children")),
                      top, taken("ends"), *near)
    at, level, edge = (made[c].tolist() for c in ("at", "level", "edge"))
    named = [e >= 0 or d == 1 for e, d in zip(edge, level)]
    made |= {"shard": np.full(len(at), key[0].as_py()), "group": [keys[i][0] if x else None for i, x in zip(at, named)],
             "prefix": [keys[i][1][:TOKEN * (d - 1)] if x else None for i, d, x in zip(at, level, named)]}
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in SHARD.split(", ")]
    return pa.table({name: pa.array(made[name], kinds[kind]) for name, kind in fields})


def _nodes(keys: DataFrame, band: int) -> DataFrame:
    """level, group (of level 1), conv, parent, members, children, leaves, saved and ends of a band's nodes."""
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    rows = written(keys.repartitionByRange(shards, "group", "tokens").withColumn("shard", F.spark_partition_id()),
                   f"trie-shards-{band}")
    key = F.struct("group", "tokens")
    bounds = rows.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    in_order = Window.orderBy("shard")  # a row a shard
    bounds = bounds.select("shard", F.lag("high").over(in_order).alias("before"), F.lead("low").over(in_order).alias("after"))
    raw = written(rows.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(_shard, SHARD), f"trie-parts-{band}")
    parts = raw.filter("edge >= 0")
    merged = parts.groupBy("group", "prefix").agg(
        F.max("level").alias("level"), F.min("conv").alias("conv"),
        *[F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")], F.max("ends").alias("ends"),
        F.max(F.when(F.col("fresh"), F.struct("shard", "parent", "parent_edge"))).alias("up"))
    known = parts.select("shard", F.col("edge").alias("parent_edge"), "group", "prefix").join(
        merged.select("group", "prefix", F.col("conv").alias("edge_conv")), ["group", "prefix"]).drop("group", "prefix")
    measures = ["level", "group", "conv", "members", "children", "leaves", "saved", "ends"]
    whole = raw.filter("edge < 0").select(*measures, "shard", "parent", "parent_edge").unionByName(
        merged.select(*measures, "up.*"))
    return whole.join(known, ["shard", "parent_edge"], "left").select(
        *measures, F.coalesce("edge_conv", "parent").alias("parent"))


# --- The trie --------------------------------------------------------------------------------

def trie(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         base: Column | None = None, head: Column | None = None) -> DataFrame:
    """conv (smallest member), depth, parent (the parent's conv; null for the root), n_convs,
    n_children, n_leaves and saved_bytes (of the subtree: bytes of last texts times the
    members beyond the first) and ends_sha256 (of the numbers of the conversations that end
    here, ascending, comma-joined) of every node. ``base`` and ``head``: see ``rebuilt``."""
    turns = turns_of(rows, conv, turn, role, text)
    if base is None:
        convs = turns.groupBy("conv").agg(F.count("*").alias("n"))
        turns = turns.withColumn("depth", F.col("idx") + 1)
    else:
        convs, turns = rebuilt(turns, base, head)
        turns = written(turns, "trie-rebuilt")
    alive = convs.select("conv", "n", F.lit(b"").alias("group"), F.lit(None).cast("bigint").alias("top"))
    bands = []
    while alive is not None:
        seqs, keys = _keys(alive, turns, len(bands))
        most = keys.agg(F.max("going")).first()[0] or 0
        bands.append((seqs, keys, most))
        alive = most > 1 and salted_lookup_join(
            seqs.filter("more").select("key", "conv", "n"),
            keys.filter("going > 1").select("key", F.col("conv").alias("top")), ["key"], salt_on=["conv"],
        ).withColumnRenamed("key", "group") or None
    out, below = [], None
    for band in range(len(bands) - 1, -1, -1):
        seqs, keys, most = bands[band]
        keys = keys.select("*", *[F.col("going").alias(c) if c != "saved" else F.lit(0).cast("bigint").alias(c)
                                  for c in ("leaves", "saved", "children")])  # of those that go on alone: 1, 0, 1
        if below is not None:
            keys = keys.drop("leaves", "saved", "children").join(below, "key", "left").select(
                *seqs.drop("n", "more").columns, "members", "ended", "ends", "going",
                *[F.coalesce(c, F.least("going", F.lit(int(c != "saved")))).alias(c) for c in ("leaves", "saved", "children")])
        nodes = _nodes(keys, band)
        if band:
            nodes = written(nodes, f"trie-nodes-{band}")
            below = nodes.filter("level = 1").select(F.col("group").alias("key"), "leaves", "saved", "children")
            nodes = nodes.filter("level > 1")
        out.append(nodes.select(
            "conv", (F.col("level").cast("long") + band * BAND - 1).alias("depth"),
            F.when(F.lit(band > 0) | (F.col("level") > 1), F.col("parent")).alias("parent"),
            F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_bytes"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")))
        if most:
            out.append(_tails(seqs, keys, turns, (band + 1) * BAND))
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _tails(seqs: DataFrame, keys: DataFrame, turns: DataFrame, high: int) -> DataFrame:
    """The chains below ``high`` of the conversations that alone go on from their key."""
    alone = keys.filter("going = 1").select("key", F.col("conv").alias("top"))
    alone = seqs.filter("more").select("key", "conv", "n").join(alone, "key").select("conv", "n", "top")
    deep = turns.filter(F.col("depth") > high).select("conv", "depth")
    one, last = F.lit(1).cast("bigint"), F.col("depth") == F.col("n")
    return salted_lookup_join(deep, alone, ["conv"], salt_on=["depth"]).select(
        "conv", "depth", F.when(F.col("depth") == high + 1, F.col("top")).otherwise(F.col("conv")).alias("parent"),
        one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_bytes"),
        F.when(last, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"))
