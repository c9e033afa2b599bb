"""Registered queries over stored tables: the sequence store, fact versions,
bucketed tables, ledger-bound streams. They add to the registry of
``plans/registry.py``, in the same form.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractlake.operators import catalog as cat
from tractlake.operators import facts, ledger, sequences
from tractlake.operators.facts import FIXED_SEQ_COLUMNS
from tractlake.plans import factstore, loads
from tractlake.plans import registry as R
from tractlake.plans import synth as S
from tractlake.plans.registry import REGISTRY, register  # noqa: F401
from tractlake.session import scratch_dir
from tractlake.sources import bucketed
from tractlake.streaming import ingest

# The queries' sequence files come from Spark, which names files itself, so
# their identity stands in the folders.
_FOLDERS = r"/kind=(?<kind>[em])/year=(?<year>\d+)/seq=(?<seq>\d+)/[^/]*$"


def _landed(spark, frames) -> str:
    """Sequence files of ``(kind, seq, frame, measures)``, one folder per kind, year and sequence.

    One write, so that what the frames have in common is computed once."""
    root, parts = scratch_dir(spark, "sequence-files"), []
    for kind, seq, df, ms in frames:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit(sequences.NULL_TEXT)) for c in [*FIXED_SEQ_COLUMNS, *ms]]
        parts.append(df.select(F.concat_ws(",", *cells).alias("value"), F.lit(kind).alias("kind"), "year",
                               F.lit(seq).alias("seq")))
    reduce(DataFrame.union, parts).write.partitionBy("kind", "year", "seq").text(root)
    return root


def _lookup_by_year(spark, d, only=None):
    """The lookup for every order and ship year; ``only`` maps a sequence to the one year that has it."""
    rows = F.array(*[F.struct(F.lit(v).alias("varid"), F.lit(s).alias("seq"), F.lit(o).alias("ordinal"))
                     for v, s, _, o in S.LOOKUP])
    orders, lines = S.table(spark, d, "orders"), S.table(spark, d, "lineitem")
    years = orders.select(F.year("o_orderdate").alias("year")).union(lines.select(F.year("l_shipdate"))).distinct()
    out = years.select("year", F.inline(rows))
    for seq, year in (only or {}).items():
        out = out.filter((F.col("seq") != seq) | (F.col("year") == year))
    return out


def _store(spark, frames, lookup_df) -> str:
    root, out = _landed(spark, frames), scratch_dir(spark, "sequence-store")
    lines = sequences.together(sequences.sequence_lines(spark, root, None, _FOLDERS))
    sequences.write_store(sequences.long_form(lines, lookup_df), out, dealt=True)
    return out


def _sequence_frames(spark, d):
    return [("e", 1, S.seq1(spark, d), S.SEQ1), ("m", 1, S.margin1(spark, d), S.SEQ1),
            ("e", 2, S.seq2(spark, d), S.SEQ2), ("e", 3, S.seq3(spark, d), S.SEQ3)]


def _long_sql(kind, table, seq, ms):
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, year, CAST({seq} AS INTEGER) AS seq, fileid, filetype, stusab, chariter, sequence, "
        f"logrecno, '{m}' AS varid, CAST({m} AS DECIMAL(16,2)) AS value FROM {table}" for m in ms)


@register("sequence_long_load", "\n" + " UNION ALL ".join(
    _long_sql(*x) for x in (("e", "seq1", 1, S.SEQ1), ("m", "margin1", 1, S.SEQ1),
                            ("e", "seq2", 2, S.SEQ2), ("e", "seq3", 3, S.SEQ3))))
def sequence_long_load(spark, d):
    """All kinds, years and sequences from their files into the long table, in one write."""
    return sequences.read_store(spark, _store(spark, _sequence_frames(spark, d), _lookup_by_year(spark, d)), None)


@register("sequence_store_wide", "\nSELECT fileid, filetype, stusab, chariter, sequence, logrecno, year, "
          + ", ".join(S.SEQ2) + " FROM seq2")
def sequence_store_wide(spark, d):
    """One sequence in its own columns again, from the store of all of them."""
    out = _store(spark, _sequence_frames(spark, d), _lookup_by_year(spark, d))
    cells = sequences.read_store(spark, out, "e", seqs=[2])
    return sequences.wide_form(cells, S.SEQ2, fixed=True)


@register("sequence_store_paired", """
SELECT year, CAST(1 AS INTEGER) AS seq, stusab, logrecno, measure, estimate, margin FROM (""" + " UNION ALL ".join(
    f"SELECT e.year, e.stusab, e.logrecno, '{m}' AS measure, e.{m} AS estimate, CAST(x.{m} AS DECIMAL(16,2)) AS margin "
    f"FROM seq1 e JOIN margin1 x USING (year, stusab, logrecno)" for m in S.SEQ1) + ")")
def sequence_store_paired(spark, d):
    """Estimates and margins of a sequence side by side, from the long table."""
    out = _store(spark, _sequence_frames(spark, d)[:2], _lookup_by_year(spark, d))
    return sequences.paired(sequences.read_store(spark, out, None))


_ONE_YEAR = 1997


def _one_year_sql():
    cols = []
    for m, sql in R._GROUP_SQL["lines"].items():
        cols.append(f"CASE WHEN g.year BETWEEN {R._WINDOWS['lines'][0]} AND {R._WINDOWS['lines'][1]} THEN {sql} END AS {m}")
    wide = R._WIDE.replace("FROM seq2", f"FROM (SELECT * FROM seq2 WHERE year = {_ONE_YEAR})")
    return f"""{wide}
SELECT g.year, g.geoid, {', '.join(cols)}
FROM geo g LEFT JOIN wide w ON w.year = g.year AND w.stusab = lower(g.stusab) AND w.logrecno = g.logrecno"""


@register("fact_sequence_of_one_year", _one_year_sql())
def fact_sequence_of_one_year(spark, d):
    """The fact of a group over several years, where one of its sequences has one year only:
    its folders of the other years do not exist."""
    frames = [("e", 1, S.seq1(spark, d), S.SEQ1),
              ("e", 2, S.seq2(spark, d).filter(F.col("year") == _ONE_YEAR), S.SEQ2)]
    lookup_df = _lookup_by_year(spark, d, {2: _ONE_YEAR})
    out = _store(spark, frames, lookup_df)
    plans = [R._group("lines")]
    wanted = plans[0].measures
    rows = lookup_df.filter(F.col("varid").isin(wanted)).collect()  # metadata: years times the group's measures
    return facts.build_fact(R._geo(spark, d), sequences.stored_sequences(spark, out, rows), rows, plans)


# ------------------------------------------------------------------ stored fact

@register("fact_store_upsert", R._fact_sql(["legacy", "lines"]))
def fact_store_upsert(spark, d):
    """A stored fact skeleton, then a version for each group's update of the years in its window."""
    root = scratch_dir(spark, "fact-store")
    g, seqs = R._landed_inputs(spark, d)
    plans = [R._group("legacy"), R._group("lines")]
    factstore.create(spark, root, facts.empty_fact(g, plans))
    for p in plans:
        factstore.upsert(spark, root, facts.group_frame(p, seqs, S.lookup_rows(), g))
    return factstore.read(spark, root)


@register("fact_store_groups", R._fact_sql(["legacy", "lines", "orders_mix", "shipping"]))
def fact_store_groups(spark, d):
    """A stored fact built by two runs of the catalog: two of its groups, then the others."""
    root = scratch_dir(spark, "fact-groups")
    areas, seqs = R._landed_inputs(spark, d)
    lookup_df = spark.createDataFrame(S.lookup_rows(), "varid string, seq int, label string, ordinal int")
    catalog_df = spark.createDataFrame(S.catalog_rows(), "group_name string, metric_name string, formula string, "
                                       "statistic string, start_year int, end_year int, ordinal int")
    for groups in (["legacy", "lines"], ["Orders_mix", "shipping"]):
        loads.update_fact_store(spark, root, areas, seqs, lookup_df, catalog_df, S.LOAD_YEAR, groups)
    return factstore.read(spark, root)


BUCKETS = 16


@register("fact_bucketed", R._fact_sql(["legacy", "lines", "orders_mix", "shipping"]))
def fact_bucketed(spark, d):
    """The flagship fact from areas and sequences that are bucketed by the join keys."""
    name = f"bucketed_{uuid.uuid4().hex}"
    areas, seqs = bucketed.load_bucketed(spark, R._geo(spark, d), S.sequences(spark, d), name, BUCKETS,
                                         scratch_dir(spark, "bucketed"))
    return facts.build_fact(areas, seqs, S.lookup_rows(), cat.plan_groups(S.catalog_rows(), S.LOAD_YEAR))


@register("fact_sliced", R._fact_sql(["legacy", "lines", "orders_mix", "shipping"]))
def fact_sliced(spark, d):
    """The flagship fact with its metrics in slices of at most twelve fields."""
    areas, seqs = R._landed_inputs(spark, d)  # every slice reads its measures of them
    return facts.build_fact(areas, seqs, S.lookup_rows(),
                            cat.plan_groups(S.catalog_rows(), S.LOAD_YEAR), max_fields=12)


# ------------------------------------------------------- ledger-bound streams

def _ledger_stream(spark, d, close: bool):
    """Notices arriving in four files, one a batch, against the stored ledger.

    ``close`` marks everything up to the day as done after every batch, which also ends
    notices that are open in the ledger and would arrive again in a later file.
    """
    landing, out, ckpt, root = (scratch_dir(spark, n) for n in ("notices", "pending", "ledger-ckpt", "ledger"))
    notices = S.notices(spark, d)
    notices.repartition(4, "email_ts").write.parquet(landing)
    ledger.write_snapshot(S.ledger(spark, d), root, 1)

    def selected(batch):
        return ledger.select_notices(batch, S.FEED_SENDER, S.FEED_PHRASE)

    def advance(batch, current):
        seen = ledger.append_unseen(current, selected(batch), S.RETRIEVE_TS)
        return ledger.close_ledger(seen, S.CLOSE_DAY) if close else seen

    def rows(batch, current):
        return ledger.pending_notices(selected(batch), current)
    pending = rows(notices, S.ledger(spark, d)).schema
    for _ in range(2):  # the second run finds nothing new
        stream = ingest.stream_with_ledger(spark, landing, notices.schema, out, ckpt, root, loads.LEDGER_SCHEMA,
                                           rows, advance, max_files=1)
    return out, root, stream, pending


@register("stream_ledger_rows", "SELECT sender, subject, email_ts, event_id, is_feed_update FROM pending")
def stream_ledger_rows(spark, d):
    """The pending notices of all committed batches."""
    out, root, stream, schema = _ledger_stream(spark, d, close=False)
    return ingest.read_committed(spark, out, root, stream, schema).select(
        "sender", "subject", "email_ts", "event_id", "is_feed_update")


@register("stream_ledger_state", R.REGISTRY["ledger_close"][1], raw=True)
def stream_ledger_state(spark, d):
    """The ledger after the last batch: every notice seen, closed up to the day."""
    _, root, _, _ = _ledger_stream(spark, d, close=True)
    return ledger.read_current(spark, root, loads.LEDGER_SCHEMA)
