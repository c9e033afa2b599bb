"""Mixing sources to target weights by a splitting tree of exact block quotas.

1. Sizes. A document's size is its number of words; a source's size is their sum.
   Sources, ordered by code point with null last, take the weights in turn and share
   ``SHARE`` of all sizes by weight. A target stops at ``MOST`` times its source's size
   and the excess is shared again by weight (water filling, in closed form).
2. Draws. Each source is dealt into up to 256 blocks by a hash of the key. With
   e = floor(target / size) every block is drawn e times; the rest of the target comes
   from blocks in a permuted order, each that still fits; what is left after that goes
   to the smallest block not drawn, up to a cut in the permuted order of its documents.
   So what a source gives differs from its target by half a document of that block at
   most, and no document is taken more than ``MOST`` times.
3. Splitting tree. The root holds the exact number of block draws of every source. Each
   node deals its draws to two children of equal size: how many of each source go left
   is a draw from the multivariate hypergeometric distribution (one univariate draw a
   source, given the ones before it). After ``DEPTH`` levels the leaves, the output
   shards, hold exact quotas whose sums over shards are the root's counts.
4. The draws of a source, permuted, go to the shards in runs as long as their quotas:
   disjoint, and all of them used. Within a shard documents are ordered by a hash. There are
   2 ** ``DEPTH`` shards, more where one would hold over ``SHARD_WORDS`` words.

The plan (steps 2 to 4) has at most 512 rows a source, whatever the number of documents;
it is joined to the documents by (source, block), which splits a hot source 256 ways.
The number of sources is metadata and must fit a row. Every choice is a hash of ``seed``
and the keys, so reruns agree. Only DataFrame functions are used.

Defined cases: null or empty text has size 0; null is a source of its own; a null key
hashes like the word null; repeated rows share their hash, so they are taken alike; a
source of size 0 has target 0; an empty table gives an empty result; further columns
pass through ``mixed`` unchanged and none can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractlake.llm.common import let, words_of, written

WEIGHTS = [3, 1, 2]
SHARE = 1.5
MOST = 2
DEPTH = 6  # at least
SHARD_WORDS = 1 << 26
STARTS = 4
SEED = "mix-1"
PLAN_FILES = 8


def _hash(*parts) -> Column:
    parts = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _block(order: Column) -> Column:
    return F.substring(order, 1, 2)


def sized(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
          seed: str = SEED) -> DataFrame:
    """key, source, size, order (the permuting hash of the document), block."""
    out = docs.select(docs[key].alias("key"), docs[source].alias("source"),
                      F.size(words_of(docs[text])).cast("long").alias("size"),
                      _hash(seed, docs[key]).alias("order"))
    return out.withColumn("block", _block(F.col("order")))


def targets(sizes: DataFrame, *, weights: list[int] | None = None, share: float = SHARE,
            most: int = MOST) -> DataFrame:
    """source, rank, source_size, target: one row a source."""
    weights = weights or WEIGHTS
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("rank"), F.lit(len(weights))))
    s = (by_source.withColumn("rank", rank).withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    # Sources fill up in the order of cap / weight. ``level`` is the target per weight if all
    # before a source are full; the first source that doesn't fill at its level sets it.
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - before) / after)
    free = F.col("level") * F.col("weight") < F.col("cap")
    s = s.withColumn("first", F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(whole))
    full = F.col("first").isNull() | (F.struct(F.col("cap") / F.col("weight"), "rank")
                                      < F.struct("first.col1", "first.rank"))
    return s.select("source", "rank", "source_size",
                    F.when(full, F.col("cap")).otherwise(F.col("first.level") * F.col("weight")).alias("target"))


def block_draws(sizes: DataFrame, goal: DataFrame, *, seed: str = SEED) -> DataFrame:
    """rank, source, block, pass, cut: one row for each time a block is drawn. ``cut`` is null
    where all of the block is drawn, else the largest ``order`` that still is."""
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    g = goal.withColumnRenamed("source", "g_source")
    b = blocks.join(g, F.col("source").eqNullSafe(F.col("g_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    listed = (b.groupBy("rank", "source", whole.cast("int").alias("whole"),
                        (F.col("target") - whole * F.col("source_size")).alias("left"))
              .agg(F.sort_array(F.collect_list(F.struct(
                  _hash(seed, "block", F.col("source"), F.col("block")).alias("order"), "block", "words")))
                  .alias("blocks")))
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<string>").alias("got"))
    fits = lambda a, x: (x["words"] > 0) & (x["words"] <= a["left"])
    fill = F.aggregate("blocks", start, lambda a, x: F.when(
        fits(a, x), F.struct((a["left"] - x["words"]).alias("left"),
                             F.concat(a["got"], F.array(x["block"])).alias("got"))).otherwise(a))
    listed = listed.withColumn("fill", fill)
    # What no block fits any more goes to the start of the smallest block not drawn.
    rest = F.array_min(F.transform(
        F.filter("blocks", lambda x: (x["words"] > 0) & ~F.array_contains(F.col("fill.got"), x["block"])),
        lambda x: F.struct(x["words"], x["order"], x["block"])))
    b = listed.select("rank", "source", "whole", F.col("fill.got").alias("got"), F.col("fill.left").alias("room"),
                      rest["block"].alias("rest"), F.explode("blocks.block").alias("block"))
    b = b.withColumn("more", F.when(F.array_contains("got", F.col("block")), "all").when(
        (F.col("block") == F.col("rest")) & (F.col("room") > 0) & (F.col("whole") < MOST), "part").otherwise("none"))
    b = written(b.select("rank", "source", "block", "whole", "more", "room"), "mix-blocks", PLAN_FILES)
    cuts = _cuts(sizes, b.filter("more = 'part'").select("rank", F.col("source").alias("p_source"),
                                                         F.col("block").alias("p_block"), "room"))
    cut = F.when(F.col("more") == "part", F.coalesce("cut", F.lit("")))
    passes = F.col("whole") + (F.col("more") != "none").cast("int")
    return (b.join(cuts, "rank", "left").filter(passes > 0)
            .select("rank", "source", "block", "whole", F.explode(F.sequence(F.lit(1), passes)).alias("pass"),
                    cut.alias("cut"))
            .withColumn("cut", F.when(F.col("pass") > F.col("whole"), F.col("cut"))).drop("whole"))


def _cuts(sizes: DataFrame, part: DataFrame) -> DataFrame:
    """rank, cut: of a block that is drawn in part, the largest ``order`` whose documents still
    lie, by their middle, in the room.

    The running sum goes over a histogram of the starts of ``order`` first (at most 16 **
    ``STARTS`` rows a source), then inside the last two starts that begin within the room: all
    documents of those before lie in it. So no block is sorted as a whole.
    """
    start = F.substring("order", 1, STARTS + 2)
    inside = sizes.join(part, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block"))).select(
        "rank", "room", "order", start.alias("start"), "size")
    before = Window.partitionBy("rank").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("rank").orderBy(F.col("start").desc())
    near = (inside.groupBy("rank", "room", "start").agg(F.sum("size").alias("words"))
            .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).filter("before <= room")
            .withColumn("n", F.row_number().over(last)).filter("n <= 2").select("rank", "start", "before"))
    rows = inside.join(near, ["rank", "start"]).groupBy("rank", "room", "start", "before", "order").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("rank", "start").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("middle", F.col("before") + F.sum("size").over(upto) - F.col("size") / 2)
            .filter("middle <= room").groupBy("rank").agg(F.max("order").alias("cut")))


def _hypergeometric(total: Column, good: Column, drawn: Column, *ids) -> Column:
    """Number of good ones among ``drawn`` of ``total``. One pass over the support keeps the
    current value with probability weight / (sum of weights so far); weights are in logs."""
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - good))
    high = F.least(good, drawn)

    def step(a, x):
        ratio = (good - x + 1) * (drawn - x + 1) / (x * (total - good - drawn + x))
        w = a["w"] + F.log(ratio)
        top = F.greatest(a["sum"], w)
        s = top + F.log(F.exp(a["sum"] - top) + F.exp(w - top))
        u = F.shiftrightunsigned(F.xxhash64(*ids, x), 11) / F.lit(float(1 << 53))
        return F.struct(w.alias("w"), s.alias("sum"), F.when(u < F.exp(w - s), x).otherwise(a["x"]).alias("x"))
    first = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("sum"), low.alias("x"))
    return F.when(high <= low, low).otherwise(
        F.aggregate(F.sequence(low + 1, high), first, step, lambda a: a["x"]))


def _split(quotas: Column, *ids) -> Column:
    """Of each source, how many of the node's draws go to its left child."""
    zero = F.lit(0).cast("long")
    n = F.aggregate(quotas, zero, lambda a, q: a + q)
    none = F.array().cast("array<bigint>")

    def step(a, q):
        x = _hypergeometric(a["total"], q, a["drawn"], *ids, F.size(a["left"]))
        return let(x, lambda v: F.struct((a["total"] - q).alias("total"), (a["drawn"] - v).alias("drawn"),
                                         F.concat(a["left"], F.array(v)).alias("left")))
    return let(n, lambda t: F.aggregate(
        quotas, F.struct(t.alias("total"), F.floor(t / 2).cast("long").alias("drawn"), none.alias("left")),
        step, lambda a: a["left"]))


def shard_quotas(draws: DataFrame, *, depth: int = DEPTH, seed: str = SEED) -> DataFrame:
    """shard, rank, k: how many draws of each source each of the 2 ** depth shards gets."""
    root = (draws.groupBy("rank").agg(F.count(F.lit(1)).alias("k"))
            .agg(F.sort_array(F.collect_list(F.struct("rank", "k"))).alias("s"))
            .select(F.lit(0).alias("node"), F.col("s.rank").alias("ranks"), F.col("s.k").alias("quotas")))
    nodes = root
    for level in range(depth):
        left = _split(F.col("quotas"), F.lit(seed), F.lit(level), F.col("node"))
        halves = let(left, lambda x: F.array(
            F.struct((F.col("node") * 2).alias("node"), x.alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"),
                     F.zip_with("quotas", x, lambda q, v: q - v).alias("quotas"))))
        nodes = nodes.select("ranks", F.explode(halves).alias("h")).select("h.node", "ranks", "h.quotas")
    return nodes.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("ranks", "quotas")).alias("q")).select(
        "shard", F.col("q.ranks").alias("rank"), F.col("q.quotas").alias("k"))


def shard_draws(draws: DataFrame, quotas: DataFrame, *, seed: str = SEED) -> DataFrame:
    """source, block, draws: of each block the array of (pass, shard, cut)."""
    end = F.sum("k").over(Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    seats = (quotas.withColumn("end", end).filter("k > 0")
             .select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("k") + 1, F.col("end"))).alias("seat")))
    order = Window.partitionBy("rank").orderBy(
        _hash(seed, "draw", F.col("source"), F.col("block"), F.col("pass")), "block", "pass")
    seated = draws.withColumn("seat", F.row_number().over(order).cast("long")).join(seats, ["rank", "seat"])
    return seated.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "cut"))).alias("draws"))


def mix_plan(sizes: DataFrame, *, weights: list[int] | None = None, share: float = SHARE, most: int = MOST,
             depth: int | None = None, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Targets by source, and draws by block; both are small tables in the shared folder."""
    goal = written(targets(sizes, weights=weights, share=share, most=most), "mix-targets", PLAN_FILES)
    if depth is None:
        words = goal.agg(F.sum("target")).first()[0] or 0
        depth = max(DEPTH, math.ceil(math.log2(max(words / SHARD_WORDS, 1))))
    draws = written(block_draws(sizes, goal, seed=seed), "mix-draws", PLAN_FILES)
    return goal, written(shard_draws(draws, shard_quotas(draws, depth=depth, seed=seed), seed=seed), "mix-plan", PLAN_FILES)


def _taken(order: Column, draws: Column, seed: str) -> Column:
    """The draws of its block that take a document: (shard, position in it, pass)."""
    mine = F.filter(F.coalesce(draws, F.array().cast("array<struct<pass:int,shard:int,cut:string>>")),
                    lambda d: d["cut"].isNull() | (order <= d["cut"]))
    return F.transform(mine, lambda d: F.struct(
        d["shard"].alias("shard"), _hash(seed, order, d["shard"], d["pass"]).alias("position"),
        d["pass"].alias("pass")))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = SEED, **options) -> DataFrame:
    """One row a document: key, source, size, source_size, target, draws (shard, position, pass)."""
    sizes = written(sized(docs, key=key, text=text, source=source, seed=seed), "mix-sizes")
    goal, plan = mix_plan(sizes, seed=seed, **options)
    g = goal.select(F.col("source").alias("g_source"), "source_size", "target")
    p = plan.select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), F.col("draws").alias("all"))
    return (sizes.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")), "left")
            .join(g, F.col("source").eqNullSafe(F.col("g_source")))
            .select("key", "source", "size", "source_size", "target",
                    _taken(F.col("order"), F.col("all"), seed).alias("draws")))


def mixed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
          seed: str = SEED, **options) -> DataFrame:
    """The mix itself: struct ``doc`` with the columns of ``docs``, once per draw, with ``shard``
    and ``position``. ``write_mix`` writes it out in that order."""
    sizes = written(sized(docs, key=key, text=text, source=source, seed=seed), "mix-sizes")
    _, plan = mix_plan(sizes, seed=seed, **options)
    p = plan.select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), "draws")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"),
                       docs[source].alias("source"), _hash(seed, docs[key]).alias("order"))
    return (rows.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (_block(F.col("order")) == F.col("p_block")))
            .select("doc", F.explode(_taken(F.col("order"), F.col("draws"), seed)).alias("d"))
            .select("doc", "d.shard", "d.position"))


def in_order(mix_rows: DataFrame) -> DataFrame:
    """The rows dealt by shard, those of each in the order of ``position``."""
    return mix_rows.repartition("shard").sortWithinPartitions("shard", "position")


def write_mix(mix_rows: DataFrame, path: str) -> None:
    """One folder a shard below ``path``, each shuffled locally: sorted by ``position``."""
    (in_order(mix_rows).select("doc.*", F.col("shard").alias("of_shard"))
     .write.partitionBy("of_shard").parquet(path))
