"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose share of something unwanted exceeds a cutoff.
Cutoffs come from a fixed ladder and are chosen per stratum (``lang``) from labelled
documents that pass the base rules:

* equal texts of a stratum count once, as bad if any of them is labelled bad: the bound
  needs independent draws, and copies are none;
* three sixteenths of the labels (first hex digit of the key's MD5 below 3; a text with copies
  if that holds for all of them) screen the ladder: a cutoff is useful if at least
  ``MIN_PRECISION`` of what it rejects is bad;
* the other labels are the holdout. A cutoff is safe if the exact (Clopper-Pearson)
  upper bound on its rate of false rejections, from the good holdout documents of the
  stratum, is at most ``MAX_FALSE / rules``. The bound is at most ``a`` exactly when
  P(Binomial(n, a) <= k) is at most the error level, so that tail is what is computed.
  The error level is ``ERROR`` over the number of (stratum, rule, cutoff) triples
  (Bonferroni), so all chosen cutoffs hold at once with probability 1 - ``ERROR``.

The lowest cutoff that is useful and safe is taken. Without one (few labels) the rule
rejects nothing in that stratum. A stratum's distinct texts are thus falsely rejected at a
rate of ``MAX_FALSE`` at most, summed over its rules. Only DataFrame functions are used.

Defined cases: null or empty text has no words and fails the base rules; null is a
stratum of its own; labels without quality are left out, a key with several labels
counts as bad if any of them is bad; a repeated document is judged each time and counts once
towards the cutoffs;
an empty table gives an empty result; further columns are neither read nor able to
clash, since the features stand in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractlake.llm.common import SPACE_CHARS, let, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LADDER = [0.5, 0.3, 0.2, 0.15, 0.1, 0.06, 0.04, 0.02]
MAX_FALSE = 0.05
ERROR = 0.1
MIN_PRECISION = 0.9
SCREEN_BELOW = "3"
# Rule -> numerator and denominator among the features.
RULES = {"symbols": ("n_symbols", "word_chars"), "echo": ("n_echo", "n_words"),
         "dup_lines": ("n_dup_lines", "n_lines")}


def _covered(hashes: Column) -> Column:
    """Positions inside windows whose hash occurs twice or more. Sorting brings equal
    windows together; overlaps of the windows found count once."""
    def of(s):
        again = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        zero = F.struct(F.lit(0).cast("long").alias("c"), F.lit(-WINDOW).alias("end"))
        return F.aggregate(
            starts, zero,
            lambda a, i: F.struct((a["c"] + F.least(F.lit(WINDOW), i - a["end"])).alias("c"), i.alias("end")),
            lambda a: a["c"])
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(pairs, of)


def _repeat_words(hashed: Column, n: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more, from the words' hashes."""
    def of(windows):
        return (F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long"))
                .otherwise(_covered(windows)))
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, of))


def features(text: Column) -> Column:
    """Struct of the counts that the rules use, each a long."""
    t = F.coalesce(text, F.lit(""))
    no_space = F.translate(t, SPACE_CHARS, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")

    def of_words(h):
        n = F.size(h)
        echo = F.size(F.filter(h, lambda x, i: F.coalesce(F.get(h, i - 1) == x, F.lit(False))))
        return F.struct(n.cast("long").alias("n_words"), echo.cast("long").alias("n_echo"),
                        _repeat_words(h, n).alias("n_repeat_words"))

    def of_lines(x):
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    w = let(F.transform(words_of(t), lambda x: F.xxhash64(x)), of_words)
    both = let(F.struct(w.alias("w"), let(lines, of_lines).alias("l")), lambda x: F.struct(
        x["w"]["n_words"], F.length(no_space).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        x["l"]["n_dup_lines"], x["w"]["n_repeat_words"], x["w"]["n_echo"], x["l"]["n_lines"]))
    return both


def base_failed(q: str = "q") -> Column:
    f = F.col(q)
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


def share(rule: str, q: str = "q") -> Column:
    num, den = RULES[rule]
    return F.col(q)[num] / F.greatest(F.col(q)[den], F.lit(1))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed in logs so that large n doesn't underflow.
    1 where k >= n * p, which is far from any error level."""
    import math
    odds, q = math.log(p / (1 - p)), math.log1p(-p)
    first = F.struct((n * F.lit(q)).alias("term"), (n * F.lit(q)).alias("total"))

    def step(a, i):
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        top = F.greatest(a["total"], term)
        return F.struct(term.alias("term"),
                        (top + F.log(F.exp(a["total"] - top) + F.exp(term - top))).alias("total"))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.exp(F.aggregate(steps, first, step, lambda a: a["total"]))
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(tail)


def cutoffs(scored: DataFrame, labels: DataFrame, *, key: str = "doc_id", stratum: str = "lang",
            ladder: list[float] | None = None, max_false: float = MAX_FALSE, error: float = ERROR,
            min_precision: float = MIN_PRECISION) -> DataFrame:
    """stratum and, per rule, ``cut_<rule>``: the chosen cutoff, null for none.

    ``scored`` has ``key``, ``stratum``, ``text_hash`` and the features as struct ``q``."""
    ladder = ladder or LADDER
    marks = (labels.select(labels[key].alias("k"), labels["quality"].alias("good"))
             .filter("good is not null and k is not null").groupBy("k").agg(F.min("good").alias("good")))
    seen = (scored.select(scored[key].alias("k"), scored[stratum].alias("stratum"), "text_hash", "q")
            .filter(~base_failed()).join(marks, "k"))
    screen = F.md5(F.col("k").cast("string").cast("binary")) < SCREEN_BELOW
    seen = seen.groupBy("stratum", "text_hash").agg(
        F.min("good").alias("good"), F.min(screen.cast("int")).alias("screen"),
        *[F.max(share(r)).alias(f"s_{r}") for r in RULES])  # equal texts have equal shares
    screen = F.col("screen") == 1
    good, bad = F.col("good") == 1, F.col("good") != 1
    counts = [F.count_if(~screen & good).alias("n")]
    steps = [(r, i, c) for r in RULES for i, c in enumerate(ladder)]
    for r, i, c in steps:
        over = F.col(f"s_{r}") > c
        counts += [F.count_if(~screen & good & over).alias(f"k_{r}_{i}"),
                   F.count_if(screen & good & over).alias(f"g_{r}_{i}"),
                   F.count_if(screen & bad & over).alias(f"b_{r}_{i}")]
    by_stratum = seen.groupBy("stratum").agg(*counts)
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # over a row a stratum
    tried = (by_stratum.withColumn("strata", strata)
             .select("stratum", "n", "strata", F.explode(F.array(*[
                 F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cut"), F.col(f"k_{r}_{i}").alias("k"),
                          F.col(f"g_{r}_{i}").alias("g"), F.col(f"b_{r}_{i}").alias("b"))
                 for r, i, c in steps])).alias("t")).select("stratum", "n", "strata", "t.*"))
    level = F.lit(error) / (F.col("strata") * len(steps))
    safe = binomial_tail(F.col("k"), F.col("n"), max_false / len(RULES)) <= level
    useful = (F.col("b") > 0) & (F.col("b") >= F.lit(min_precision) * (F.col("b") + F.col("g")))
    return tried.filter(safe & useful).groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def judged(scored: DataFrame, chosen: DataFrame, *, stratum: str = "lang") -> DataFrame:
    """``scored`` with struct ``verdict``: base_failed, kept, broken (names of the rules that reject)."""
    c = written(chosen.withColumnRenamed("stratum", "_stratum"), "cutoffs", 1)  # a row a stratum
    out = scored.join(c, scored[stratum].eqNullSafe(c["_stratum"]), "left")
    broken = F.filter(F.array(*[F.when(share(r) > c[f"cut_{r}"], F.lit(r)) for r in RULES]),
                      lambda x: x.isNotNull())
    return out.select(*[scored[f"`{x}`"] for x in scored.columns], F.struct(
        base_failed().alias("base_failed"), (~base_failed() & (F.size(broken) == 0)).alias("kept"),
        broken.alias("broken")).alias("verdict"))


def quality(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
            stratum: str = "lang", **options) -> DataFrame:
    """key, stratum, text_hash, features ``q`` and ``verdict`` of each document."""
    scored = written(docs.select(docs[key], docs[stratum], F.xxhash64(docs[text]).alias("text_hash"),
                                 features(docs[text]).alias("q")), "quality")
    chosen = cutoffs(scored, labels, key=key, stratum=stratum, **options)
    return judged(scored, chosen, stratum=stratum)


def keep_good(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
              stratum: str = "lang", **options) -> DataFrame:
    """The documents that pass, with their columns. The features are written without the
    texts; what they reject is named by key, stratum and the text's hash."""
    seen = docs.select(docs[key].alias("key"), docs[stratum].alias("stratum"), docs[text].alias("text"))
    named = labels.select(labels[key].alias("key"), "quality")
    out = quality(seen, named, key="key", text="text", stratum="stratum", **options)
    bad = out.filter("not verdict.kept").select("key", "stratum", "text_hash").distinct()
    return docs.join(bad, docs[key].eqNullSafe(bad["key"]) & docs[stratum].eqNullSafe(bad["stratum"])
                     & (F.xxhash64(docs[text]) == bad["text_hash"]), "left_anti")
