"""Registered queries of this subpackage: name -> (query, oracle SQL or None)."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

import corpus_pipeline
from tractlake.llm import bytebpe, exact_dedup, htmltext, merkle, mixing, pieces, prefixtrie, quality, secrets, simhash, warc, wavelet, wordpiece
from tractlake.llm.common import table

REGISTRY = {}


def register(name, sql=None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return add


@register("op1_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op1_exact_dedup(spark, d):
    out = exact_dedup.dedup_files(spark, f"{d}/documents.parquet")
    return out.select(F.col("id.key").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


def _quality_sql():
    shares = ", ".join(f"{a} / greatest({b}, 1) AS s_{r}" for r, (a, b) in quality.RULES.items())
    p = quality.MAX_FALSE / len(quality.RULES)
    level = f"{quality.ERROR} / ((SELECT count(DISTINCT coalesce(lang, chr(1))) FROM seen) * {len(quality.RULES) * len(quality.LADDER)})"
    tried = " UNION ALL ".join(
        f"""SELECT lang, '{r}' AS rule, cut, count(*) FILTER (hold AND good = 1) AS n,
          count(*) FILTER (hold AND good = 1 AND s_{r} > cut) AS k,
          count(*) FILTER (NOT hold AND good = 1 AND s_{r} > cut) AS g,
          count(*) FILTER (NOT hold AND good <> 1 AND s_{r} > cut) AS b
        FROM seen, ladder GROUP BY lang, cut""" for r in quality.RULES)
    cuts = ", ".join(f"min(cut) FILTER (rule = '{r}') AS cut_{r}" for r in quality.RULES)
    passed = " AND ".join(f"coalesce(s_{r} <= cut_{r}, true)" for r in quality.RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ 	-
]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls FROM d),
g AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM w, unnest(range(1, len(w) - 6)) u(i)),
r AS (SELECT rid, count(DISTINCT i + j) AS n FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g),
    range(8) v(j) WHERE c > 1 GROUP BY rid),
f AS (SELECT w.*, len(w) AS n_words, length(regexp_replace(t, '[ 	-
]', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    len(ls) AS n_lines, len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_echo,
    coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
s AS (SELECT *, {shares}, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
l AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
seen AS (SELECT lang, t, min(good) AS good, bool_or(md5(CAST(s.doc_id AS VARCHAR)) >= '{quality.SCREEN_BELOW}') AS hold,
    {", ".join(f"max(s_{r}) AS s_{r}" for r in quality.RULES)} FROM s JOIN l USING (doc_id) WHERE NOT base_failed GROUP BY lang, t),
ladder AS (SELECT unnest({quality.LADDER}) AS cut), tried AS ({tried}),
tails AS (SELECT *, CASE WHEN k >= n * {p} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) END AS tail FROM tried),
cuts AS (SELECT lang, {cuts} FROM tails
    WHERE tail <= {level} AND b > 0 AND b >= {quality.MIN_PRECISION} * (b + g) GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {passed} AS kept
FROM s LEFT JOIN cuts ON s.lang IS NOT DISTINCT FROM cuts.lang"""


@register("op2_quality_rules", _quality_sql())
def op2_quality_rules(spark, d):
    out = quality.quality(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select("doc_id", *[F.col(f"q.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "verdict.base_failed", "verdict.kept")


@register("op7_source_mixing")
def op7_source_mixing(spark, d):
    out = mixing.mix(table(spark, d, "documents"))
    return out.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                      (F.size("draws") * F.col("size")).alias("taken"), "draws")


@register("op4_simhash_bktree")
def op4_simhash_bktree(spark, d):
    out = simhash.simhash_dedup(table(spark, d, "documents"))
    return out.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@register("op10_sentencepiece_viterbi")
def op10_sentencepiece_viterbi(spark, d):
    return pieces.encode_and_check(table(spark, d, "documents")).withColumnRenamed("key", "doc_id")


@register("op3_warc_salvage", """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages)
SELECT page_id, strlen(t) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)),
    '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM p WINDOW w AS (PARTITION BY t)""")
def op3_warc_salvage(spark, d):
    read = warc.read_warc(warc.write_warc(table(spark, d, "pages")), payload=False)
    return read.filter("kind = 'record'").select(
        F.col("record_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


@register("op9_wavelet_tokens")
def op9_wavelet_tokens(spark, d):
    shards = wavelet.write_shards(table(spark, d, "documents"))
    return wavelet.read_shards(shards).withColumnRenamed("key", "doc_id")


@register("op5_host_suffix_array")
def op5_host_suffix_array(spark, d):
    return htmltext.main_text(table(spark, d, "pages")).withColumnRenamed("page", "page_id")


@register("op6_wordpiece_counts")
def op6_wordpiece_counts(spark, d):
    return wordpiece.token_counts(table(spark, d, "documents")).withColumnRenamed("key", "doc_id")


@register("op8_secret_scan")
def op8_secret_scan(spark, d):
    found = secrets.scan(table(spark, d, "documents"))
    base = F.filter("spans", lambda s: s["depth"] == 0)
    n = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col("key").alias("doc_id"), *[n(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(secrets.spelt(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.spelt(F.col("spans")).alias("spans"), "n_cut")


@register("op11_byte_bpe")
def op11_byte_bpe(spark, d):
    return bytebpe.encode_and_check(table(spark, d, "documents")).withColumnRenamed("key", "doc_id")


def _crc_sql(n):
    """crc32 of an integer's decimal digits, by its definition."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({n}::VARCHAR) + 1),
        lambda i: ascii(substr({n}::VARCHAR, i, 1))::BIGINT)), lambda c, b:
        list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@register("op12_prefix_trie", f"""
WITH t AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations),
o AS (SELECT conv_id, list(x ORDER BY i) AS own, {_crc_sql("conv_id")} % 9 AS h FROM t GROUP BY conv_id),
s AS MATERIALIZED (SELECT o.conv_id, coalesce(b.own[1:o.h], []) || o.own[o.h + 1:] AS s FROM o
    LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5),
p AS MATERIALIZED (SELECT conv_id, d, s[1:d] AS p, len(s) = d AS here FROM s, unnest(range(0, len(s) + 1)) u(d)),
n AS MATERIALIZED (SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (here), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN (count(*) - 1) * strlen(p[d].t) ELSE 0 END AS saved FROM p GROUP BY p, d),
c AS MATERIALIZED (SELECT p[1:depth - 1] AS p, count(*) AS k FROM n WHERE depth > 0 GROUP BY 1),
a AS (SELECT n.p[1:d] AS p, sum(saved)::BIGINT AS saved, count(*) FILTER (k IS NULL) AS leaves
    FROM n LEFT JOIN c USING (p), unnest(range(0, depth + 1)) u(d) GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.k, 0) AS n_children, a.leaves AS n_leaves,
  a.saved AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN c USING (p) JOIN a USING (p) LEFT JOIN n up ON up.depth = n.depth - 1 AND up.p = n.p[1:n.depth - 1]""")
def op12_prefix_trie(spark, d):
    conv = F.col("conv")
    out = prefixtrie.trie(table(spark, d, "conversations"), base=conv - conv % 5,
                          head=F.crc32(conv.cast("string").cast("binary")) % 9)
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                      "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256")


def _merkle_sql(levels=7, top_levels=5):
    """The trees level by level; a level that has one node left passes it on."""
    def tree(name, leaves, n, by):
        parts = [f"{name}0 AS MATERIALIZED (SELECT {by}, idx, h, count(*) OVER (PARTITION BY {by}) AS n FROM {leaves})"]
        for i in range(n):
            parts.append(f"""{name}r{i} AS MATERIALIZED (SELECT {by}, idx // 16 AS run, list(h ORDER BY idx) AS hs, min(n) AS n
                FROM {name}{i} GROUP BY ALL)""")
            parts.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT {by}, run AS idx, CASE WHEN n = 1 THEN hs[1]
                ELSE sha256(array_to_string(hs, '')) END AS h, (n + 15) // 16 AS n FROM {name}r{i})""")
        return parts

    def walk(rows, name, n, by, prefix):
        parts, last = [], rows
        for i in range(n):
            k = f"{last}.idx % 16 + 1"
            parts.append(f"""{prefix}{i} AS MATERIALIZED (SELECT {last}.* EXCLUDE (idx, proof, cur), idx // 16 AS idx,
                proof || CASE WHEN r.n = 1 THEN '' ELSE array_to_string(hs[1:{k} - 1] || hs[{k} + 1:], '') END AS proof,
                CASE WHEN r.n = 1 THEN cur ELSE sha256(array_to_string(hs[1:{k} - 1] || [cur] || hs[{k} + 1:], '')) END AS cur
                FROM {last} JOIN {name}r{i} r ON r.{by} = {last}.{by} AND r.run = {last}.idx // 16)""")
            last = f"{prefix}{i}"
        return parts, last
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    down = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    one, doc = walk("d", "s", levels, "tree", "w")
    two, end = walk("u", "t", top_levels, "whole", "v")
    return ", ".join(["WITH l AS (SELECT doc_id, coalesce('1' || source, '') AS tree, sha256(%s || %s) AS h, CASE WHEN"
                      " %s %% 5 = 0 THEN sha256(%s || %s) END AS shown FROM documents)" % (
                          head, field("text"), _crc_sql("doc_id"), head, field(f"({down})")),
                      "n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM l)",
                      *tree("s", "n", levels, "tree"),
                      f"x AS MATERIALIZED (SELECT 1 AS whole, tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx FROM s{levels})",
                      *tree("t", "x", top_levels, "whole"),
                      "d AS (SELECT doc_id, tree, h AS leaf, idx, '' AS proof, coalesce(shown, h) AS cur FROM n)", *one,
                      f"u AS (SELECT {doc}.* EXCLUDE (idx), x.idx, x.h AS subroot, 1 AS whole FROM {doc} JOIN x USING (tree))", *two]) + f"""
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
FROM {end} CROSS JOIN t{top_levels} t"""


@register("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark, d):
    docs = table(spark, d, "documents")
    tampered = merkle.leaf_digest(*[docs[c] for c in ("doc_id", "source", "lang", "n_chars")],
                                  F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    return merkle.check(merkle.manifest(docs, shown=F.when(hit, tampered))).withColumnRenamed("key", "doc_id")


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)
