"""End-to-end load jobs: each of the reference's scheduled tasks as one
Spark job built from the library's operators.

All paths are folders on shared storage. Metadata (catalog, lookup, folder
listing) is collected on the driver to shape the plan; data never is.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.operators import catalog as cat
from tractlake.operators import facts, feeds, geo, ledger, lookup, sequences
from tractlake.plans import factstore
from tractlake.session import scratch_dir
from tractlake.sources import archives, files, workbooks
from tractlake.streaming import ingest


def _binary(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root))


def load_geo(spark: SparkSession, root: str, out: str | None = None,
             year_pattern: str = r"/(\d{4})/", glob: str = "*.xlsx") -> DataFrame:
    """Geo workbooks under ``root`` (one folder per year, one sheet per
    region) → area table, written partitioned by year when ``out`` is set."""
    rows = workbooks.land_workbook_rows(_binary(spark, root, glob))
    stacked = workbooks.stack_sheets(rows).withColumn(
        "year", F.regexp_extract("path", year_pattern, 1).cast("int"))
    areas = geo.build_geo(stacked)
    if out:
        files.load_table(areas, out, partition_by=["year"])
        return spark.read.parquet(out)
    return areas


TEMPLATE_NAME_PATTERN = r"/(?:S|s)eq(\d*)\.xlsx?$"


def load_lookup(spark: SparkSession, root: str, out: str | None = None,
                year_pattern: str = r"/(\d{4})/", glob: str = "*eq*.xlsx",
                pattern: str = TEMPLATE_NAME_PATTERN) -> DataFrame:
    """Template workbooks → lookup (year, varid, seq, label, ordinal).

    Files whose name is ``Seq<n>`` / ``seq<n>`` are templates; others (and
    a name without a number) are skipped.
    """
    rows = workbooks.read_workbook_rows(_binary(spark, root, glob))
    rows = rows.withColumn("year", F.regexp_extract("path", year_pattern, 1).cast("int"))
    out_df = workbooks.read_templates(rows, pattern, keep=("year",))
    if out:
        files.load_table(out_df, out, partition_by=["year"])
        return spark.read.parquet(out)
    return out_df


def load_sequence_store(spark: SparkSession, root: str, years, lookup_df: DataFrame, out: str) -> DataFrame:
    """Estimate and margin files of all sequences and years → one long table
    partitioned by kind / year / seq, in one plan and one write.

    Only files in the folders of the survey's layout count. Returns the
    (kind, year, seq) that were skipped because the lookup of their year does
    not list them. Read the store with ``sequences.stored_sequences``.
    """
    years = [int(y) for y in (years if isinstance(years, (list, tuple, range)) else [years])]
    lines = sequences.sequence_lines(spark, root).filter(F.col("year").isin(years))
    listing_df = _binary(spark, root, "g*").select("path")
    lines = sequences.together(sequences.of_known_folders(lines, listing_df, years))
    sequences.write_store(sequences.long_form(lines, lookup_df), out, dealt=True)
    return sequences.unlisted(sequences.landed_files(spark, root).filter(F.col("year").isin(years)), lookup_df)


def load_sequences(spark: SparkSession, root: str, year: int, lookup_rows, out: str,
                   seqs=None, parallel: int = 4) -> list:
    """Estimate and margin files of each sequence → one wide parquet table per
    kind / year / seq, for readers that want a sequence's own columns.

    The files are read once, into the long form; no path reaches the driver.
    Sequences have different widths, so each wide table is its own write;
    ``parallel`` of them run as concurrent jobs. A sequence missing from the
    lookup is skipped (and reported).
    """
    listed = sorted({int(r["seq"]) for r in lookup_rows})
    todo = [int(s) for s in (seqs or listed)]
    wanted = [s for s in todo if s in listed]
    rows = [(r["varid"], int(r["seq"]), int(r["ordinal"] or 0)) for r in lookup_rows if int(r["seq"]) in wanted]
    if rows:
        store = scratch_dir(spark, "sequence-store")
        load_sequence_store(spark, root, year, spark.createDataFrame(rows, "varid string, seq int, ordinal int"), store)
        cells = sequences.read_store(spark, store, None, [year])
        landed = {(r["kind"], r["seq"]) for r in cells.select("kind", "seq").distinct().collect()}

        def one(at):
            kind, seq = at
            order = [f.name for f in lookup.sequence_wide(lookup_rows, seq).fields[len(facts.FIXED_SEQ_COLUMNS):]]
            wide = sequences.wide_form(sequences.read_store(spark, store, kind, [year], [seq]), order, fixed=True)
            wide.drop("year").write.mode("overwrite").parquet(f"{out}/kind={kind}/year={year}/seq={seq}")

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            list(pool.map(one, sorted(landed)))
    return [("loaded", s) for s in wanted] + [("skipped", s) for s in todo if s not in listed]


def read_loaded_sequences(spark: SparkSession, out: str, year, seqs, kind: str = "e") -> dict:
    """seq → DataFrame of one loaded sequence (with a ``year`` column).

    ``year`` is one year, or a list of years to stack: a measure that a year
    does not have is NULL there, and a year that lacks the sequence has no
    rows. A sequence that no year has is left out of the result.
    """
    years = list(year) if isinstance(year, (list, tuple, range)) else [year]
    base = f"{out}/kind={kind}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{base}/year=*/seq=*")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Folder names only: at most one per year and sequence.
    there = {tuple(str(s.getPath().toString()).rsplit("/", 2)[1:]) for s in fs.globStatus(at) or []}
    out_frames = {}
    for s in seqs:
        folders = [f"{base}/year={y}/seq={s}" for y in years if (f"year={y}", f"seq={s}") in there]
        if folders:
            df = spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*folders)
            out_frames[s] = df.drop("seq").withColumn("year", F.col("year").cast("int"))
    return out_frames


LEDGER_SCHEMA = ("retrieve_ts timestamp_ntz, email_ts timestamp_ntz, email_subject string, "
                 "is_feed_update boolean, updated boolean, stage_location string")


def run_feed_batch(spark: SparkSession, notices: DataFrame, ledger_root: str,
                   feed_root: str, out_root: str, feeds_by_table: dict, sender: str,
                   run_ts: str, phrase: str = ledger.DEFAULT_PHRASE,
                   prefix: str = ledger.DEFAULT_PREFIX) -> dict:
    """One feed batch: ledger → newest pending folder → feed tables → ledger.

    ``feeds_by_table`` maps a table name to (zip file glob, layout). Feed
    tables are written first; the closed ledger is written last as a new
    version, so a crash before that leaves the batch pending for the rerun.
    """
    current = ledger.read_current(spark, ledger_root)
    version = ledger.current_version(spark, ledger_root) or 0
    sel = ledger.select_notices(notices, sender, phrase)
    if current is None:
        current = spark.createDataFrame([], LEDGER_SCHEMA)
    batch = ledger.current_batch(ledger.pending_notices(sel, current), prefix).collect()[0]
    appended = ledger.append_unseen(current, sel, run_ts, prefix)
    if batch["stage_location"] is None:
        ledger.write_snapshot(appended, ledger_root, version + 1)
        return {"batch": None, "tables": []}
    folder = f"{feed_root}/{batch['stage_location']}"
    written = []
    for name, (glob, layout) in feeds_by_table.items():
        members = archives.expand_archives(_binary(spark, folder, glob), keep_dirs=False)
        files.load_table(feeds.read_feed_members(members, layout, by_position=True), f"{out_root}/{name}")
        written.append(name)
    closed = ledger.close_ledger(appended, batch["batch_date"])
    ledger.write_snapshot(closed, ledger_root, version + 1)
    return {"batch": batch["stage_location"], "tables": written}


def run_feed_stream(spark: SparkSession, notices_root: str, notices_schema, ledger_root: str,
                    feed_root: str, out_root: str, checkpoint: str, feeds_by_table: dict, sender: str,
                    run_ts: str, phrase: str = ledger.DEFAULT_PHRASE,
                    prefix: str = ledger.DEFAULT_PREFIX, max_files: int = 1) -> str:
    """The poll as a stream: notices that arrived since the last run → feed tables and ledger.

    Every micro-batch of notices is one :func:`run_feed_batch`: the newest
    folder of its pending feed notices is read into the feed tables, unseen notices join the
    ledger, and all up to the folder's date are closed. Tables and ledger
    version are committed by one write, so a batch that is lost half-way leaves
    the tables and the ledger as they were, and its replay does all of it.
    Without a pending feed notice the tables stay. Returns the stream's id for
    ``ingest.read_replaced``.
    """
    found = {}

    def tables(batch, current):
        sel = ledger.select_notices(batch, sender, phrase)
        found["batch"] = ledger.current_batch(ledger.pending_notices(sel, current), prefix).collect()[0]
        if found["batch"]["stage_location"] is None:
            return {}
        folder = f"{feed_root}/{found['batch']['stage_location']}"
        return {name: feeds.read_feed_members(archives.expand_archives(_binary(spark, folder, glob), keep_dirs=False),
                                              layout, by_position=True)
                for name, (glob, layout) in feeds_by_table.items()}

    def advance(batch, current):
        appended = ledger.append_unseen(current, ledger.select_notices(batch, sender, phrase), run_ts, prefix)
        day = found["batch"]["batch_date"]
        return appended if day is None else ledger.close_ledger(appended, day)
    return ingest.stream_with_ledger(spark, notices_root, notices_schema, out_root, checkpoint, ledger_root,
                                     LEDGER_SCHEMA, tables, advance, max_files=max_files)


def build_fact_table(spark: SparkSession, areas: DataFrame, sequences: dict, lookup_df: DataFrame,
                     catalog_df: DataFrame, load_year: int, out: str | None = None,
                     year_override=None) -> DataFrame:
    """Catalog + lookup (metadata, collected) → fact table in one plan.

    The catalog is taken in the order of ``ordinal``; a lookup with a
    ``year`` column is resolved year by year.
    """
    named = ["group_name", "metric_name", "formula", "statistic", "start_year", "end_year"]
    if "ordinal" in catalog_df.columns:
        catalog_df = catalog_df.orderBy("ordinal")
    plans = cat.plan_groups(catalog_df.select(*named).collect(), load_year, year_override)
    wanted = sorted({m for p in plans for m in p.measures})
    # only the lookup rows of measures the catalog names reach the driver
    columns = [c for c in ("year", "varid", "seq", "ordinal") if c in lookup_df.columns]
    rows = lookup_df.filter(F.col("varid").isin(wanted)).select(*columns).collect()
    fact = facts.build_fact(areas, sequences, rows, plans)
    if out:
        files.load_table(fact, out, partition_by=["year"])
        return spark.read.parquet(out)
    return fact


def update_fact_store(spark: SparkSession, root: str, areas: DataFrame, sequences: dict,
                      lookup_df: DataFrame, catalog_df: DataFrame, load_year: int, groups=None,
                      year_override=None) -> dict:
    """Run catalog groups against the stored fact: years the store lacks are
    added with the areas' keys, then the groups' metrics overwrite the cells of the
    years in their windows, in ascending group name, all in one new version.

    ``groups`` limits the run to some groups of the catalog (all by default).
    Returns the added and the updated years.
    """
    named = ["group_name", "metric_name", "formula", "statistic", "start_year", "end_year"]
    if "ordinal" in catalog_df.columns:
        catalog_df = catalog_df.orderBy("ordinal")
    plans = cat.plan_groups(catalog_df.select(*named).collect(), load_year, year_override)
    if groups is not None:
        wanted_groups = {g.strip().lower() for g in groups}
        unknown = wanted_groups - {p.name for p in plans}
        if unknown:
            raise cat.CatalogError(f"groups not in the catalog: {', '.join(sorted(unknown))}")
        plans = [p for p in plans if p.name in wanted_groups]
    years = factstore.years_of(areas)
    added = factstore.add_years(spark, root, facts.empty_fact(areas, plans), years)["years"]
    if all(p.empty for p in plans):
        return {"added": added, "updated": []}
    wanted = sorted({m for p in plans for m in p.measures})
    columns = [c for c in ("year", "varid", "seq", "ordinal") if c in lookup_df.columns]
    rows = lookup_df.filter(F.col("varid").isin(wanted)).select(*columns).collect()  # metadata
    stacked = facts.stacked_groups(plans, sequences, rows, areas)
    # every area of a window's years has a row in the stack
    years = {y for y in years if y is not None and any(p.first_year <= y <= p.last_year for p in plans if not p.empty)}
    return {"added": added, "updated": factstore.upsert(spark, root, stacked, rank="rank", years=years)["years"]}
