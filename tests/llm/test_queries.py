"""Registered queries of the subpackage: oracles, contracts, and the pipeline by brute force."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_documents import _fingerprint
from tools.check_oracle import TABLES, rows_of
from tractlake.llm import mixing, pieces
from tractlake.llm.common import written
from tractlake.llm.queries import REGISTRY
from tractlake.session import scratch_dir


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_oracle(spark, con, name):
    df, res = REGISTRY[name][0](spark, SF_SMALL), con.sql(REGISTRY[name][1])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())


def test_one_query_an_operator():
    assert collections.Counter(n.split("_")[0] for n in REGISTRY) == {f"op{i}": 1 for i in range(1, 14)} | {"pipeline": 1}


def test_pipeline_stages(spark):
    """Each stage on its own input: what it keeps follows from that input, by brute force."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    kept = {r.doc_id for r in REGISTRY["op2_quality_rules"][0](spark, SF_SMALL).filter("kept").collect()}
    one = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == kept and 0 < len(kept) < n
    two = corpus_pipeline.exact_copies(spark, one, SF_SMALL).cache()
    top = collections.defaultdict(int)
    for r in one.collect():
        top[r.text] = max(top[r.text], r.doc_id)
    assert two.columns == columns and {r.doc_id for r in two.collect()} == set(top.values())
    three = corpus_pipeline.near_copies(spark, two, SF_SMALL).cache()
    fps = {r.doc_id: _fingerprint(r.text) for r in two.collect()}
    group = {}
    for d in sorted(fps):  # smallest first, through links of at most two bits
        todo = [] if d in group else [d]
        while todo:
            x = todo.pop()
            if group.setdefault(x, d) == d:
                todo += [y for y in fps if y not in group and (fps[x] ^ fps[y]).bit_count() <= 2]
    assert three.columns == columns and {r.doc_id for r in three.collect()} == set(group.values())
    four = written(corpus_pipeline.source_mix(spark, three, SF_SMALL), "test-mix")
    times = collections.Counter(r.doc_id for r in four.collect())
    draws = {r.key: len(r.draws) for r in mixing.mix(three).collect()}
    assert four.columns == columns and times == collections.Counter({k: v for k, v in draws.items() if v})
    last = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert collections.Counter(r.doc_id for r in last) == times
    vocab, texts = pieces.load(pieces.default_model()), {r.doc_id: r.text for r in four.collect()}
    assert all(r.round_trip and vocab.decode(r.ids) == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in last)


def test_mix_is_written_by_shard_and_position(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = collections.defaultdict(list)
    for r in mixing.mixed(docs).select("doc.doc_id", "shard", "position").collect():
        want[r.shard].append((r.position, r.doc_id))
    path = scratch_dir(spark, "test-shards")
    mixing.write_mix(mixing.mixed(docs), path)
    got = collections.defaultdict(list)
    for r in spark.read.parquet(path).select("of_shard", "doc_id", F.col("_metadata.row_index").alias("at")).collect():
        got[r.of_shard].append((r.at, r.doc_id))
    assert {s: [d for _, d in sorted(x)] for s, x in got.items()} == {s: [d for _, d in sorted(x)] for s, x in want.items()}


EDGE = ("doc_id bigint, text string, lang string, source string, n_chars bigint, key string, q int, fp string, digest binary, "
        "shard int, kept boolean, order string, stratum string, label int")


def _edges():
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, text, "en", "a", 1), (4, text, None, None, 2),
            (None, text + " null key", "fr", "b", 3), (6, " ".join(f"long{i}" for i in range(60000)), "en", "b", 4),
            (7, "too short", "en", "a", 5), (8, " ".join(f"other{i}" for i in range(30)), "en", "a", 6)]
    rows.append(rows[-1])  # a repeated row
    return [(*r, "k", 1, "f", b"d", 2, False, "o", "s", 3) for r in rows]


def test_pipeline_on_edge_rows_and_empty_tables(spark):
    docs = spark.createDataFrame(_edges(), EDGE).repartition(3)
    after = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF_SMALL), f"edge-{name}")
        assert out.columns == docs.columns and out.filter("key <> 'k' or label <> 3 or shard <> 2").count() == 0
        docs = out
        after.append(collections.Counter(r.doc_id for r in out.collect()))
    quality, exact, near, mix = after
    assert quality == {3: 1, 4: 1, None: 1, 6: 1, 8: 2} and exact == {4: 1, None: 1, 6: 1, 8: 1}
    assert set(near) <= set(exact) and set(mix) <= set(near) and max(mix.values()) <= 2
    last = corpus_pipeline.token_ids(spark, docs, SF_SMALL)
    assert collections.Counter(r.doc_id for r in last.collect()) == mix and last.filter("not round_trip").count() == 0
    docs = spark.createDataFrame([], EDGE)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.collect() == []


def test_empty_texts_pass_the_later_stages(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, None, None)], "doc_id bigint, text string, source string")
    exact = corpus_pipeline.exact_copies(spark, docs, SF_SMALL)
    assert [r.doc_id for r in exact.collect()] == [3]
    assert corpus_pipeline.near_copies(spark, docs, SF_SMALL).count() == 1
    assert corpus_pipeline.source_mix(spark, docs, SF_SMALL).count() == 0  # targets of 0 words
    assert [(r.n_tokens, r.round_trip) for r in corpus_pipeline.token_ids(spark, docs, SF_SMALL).collect()] == [(0, True)] * 3
