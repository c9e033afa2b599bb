"""Sequences → metric tables → the wide fact table.

Keys: a sequence row is identified by (year, region code, record no); the
region code is compared in lower case. Every join below is an equi-join on
those keys or on (year, area id), so Spark hash-partitions once per side and
keeps that partitioning through the fold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.operators.catalog import CatalogError, GroupPlan
from tractlake.operators.formulas import names_of, unquoted

SEQ_KEYS = ["stusab", "logrecno"]
# The six leading text columns of every sequence file.
FIXED_SEQ_COLUMNS = ["fileid", "filetype", "stusab", "chariter", "sequence", "logrecno"]
JOIN_KEYS = ["year", "stusab_key", "logrecno"]


def region_key(c="stusab") -> Column:
    return F.lower(F.col(c))


def prune_measures(seq: DataFrame, measures, year: int | None = None) -> DataFrame:
    """Keys, year and only the wanted measures of one sequence.

    With a parquet or CSV source Spark reads just these columns. When the
    sequence has no ``year`` column the literal ``year`` is added.
    """
    cols = [F.col("stusab_key" if "stusab_key" in seq.columns else "stusab"), F.col("logrecno")]
    if "year" in seq.columns:
        df = seq if year is None else seq.filter(F.col("year") == year)
        cols.insert(0, F.col("year").cast("int").alias("year"))
    else:
        df = seq
        cols.insert(0, F.lit(year).cast("int").alias("year"))
    return df.select(*cols, *[F.col(m) for m in measures])


def _keyed(df: DataFrame) -> DataFrame:
    if "stusab_key" in df.columns:
        return df
    return df.withColumn("stusab_key", region_key("stusab")).drop("stusab")


def join_sequences(frames, keys=JOIN_KEYS, strategy: str = "union") -> DataFrame:
    """Combine sequence frames so every key of any frame appears once.

    ``strategy="union"`` (default): stack the frames by name and take the
    single value per key and measure — one shuffle for any number of frames,
    and the output stays hash-partitioned on the keys for the next join. A
    key repeated inside one frame fails the job (checked in the same
    aggregate). ``strategy="full"``: a chain of FULL OUTER joins with
    coalesced keys (``USING``), each step compared with the combined keys so
    no row is lost.
    """
    frames = [_keyed(f) for f in frames]
    if len(frames) == 1 or strategy == "full":
        return reduce(lambda a, b: a.join(b, list(keys), "full"), [unique_by_key(f, keys) for f in frames])
    measures = []
    tagged = []
    for i, f in enumerate(frames):
        ms = [c for c in f.columns if c not in keys]
        measures += [m for m in ms if m not in measures]
        tagged.append(f.withColumn(f"_src{i}", F.lit(1)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    aggs = [F.max(m).alias(m) for m in measures]
    aggs += [F.count(f"_src{i}").alias(f"_n{i}") for i in range(len(frames))]
    combined = stacked.groupBy(*keys).agg(*aggs)
    dup = reduce(lambda a, b: a | b, [F.col(f"_n{i}") > 1 for i in range(len(frames))])
    # A filter that raises keeps the aggregate's hash partitioning intact and
    # cannot be pruned away, unlike a check hidden in one output column.
    checked = combined.filter(
        F.when(dup, F.raise_error(F.lit("duplicate key inside one sequence"))).otherwise(F.lit(True)))
    return checked.select(*keys, *measures)


def unique_by_key(seq: DataFrame, keys=JOIN_KEYS,
                  message: str = "duplicate key inside one sequence") -> DataFrame:
    """One row per key of a sequence frame; a repeated key fails the job.

    The aggregate's shuffle is on the join keys, so it doubles as the
    shuffle of the join that follows: the check costs no extra exchange.
    """
    keys = list(keys)
    ms = [c for c in seq.columns if c not in keys]
    agg = seq.groupBy(*keys).agg(*[F.first(m).alias(m) for m in ms],
                                 F.count(F.lit(1)).alias("_n"))
    checked = agg.filter(F.when(F.col("_n") > 1, F.raise_error(F.lit(message))).otherwise(F.lit(True)))
    return checked.select(*keys, *ms)


def areas_with_measures(areas: DataFrame, sequences: dict, lookup_rows, measures,
                        years=None, missing: str = "raise") -> DataFrame:
    """Areas LEFT JOIN each needed sequence on (year, region, record).

    Only area rows matter downstream, so each sequence is joined to the areas
    directly: every sequence is shuffled once with just its own measures,
    and because a left join keeps the left side's hash partitioning, the area
    side is shuffled once for the whole chain (no wide intermediate rows).
    ``areas`` must carry ``year``, ``stusab_key`` and ``logrecno``. Lookup
    rows with a ``year`` are resolved year by year: a measure that moves to
    another sequence is read from the one of its year.
    """
    homes = measure_homes(measures, lookup_rows, missing)
    by_seq: dict = {}
    for m, seqs in homes.items():
        for s in seqs:
            by_seq.setdefault(s, []).append(m)
    out, parts = areas, {}
    for s in sorted(by_seq):
        ms = sorted(by_seq[s], key=lambda m: (homes[m][s][1], m))
        if s not in sequences and missing == "null":  # listed, but no year has its file
            continue
        f = _keyed(prune_measures(sequences[s], ms))
        if years is not None:
            f = f.filter(F.col("year").between(years[0], years[1]))
        for m in ms:
            at = homes[m][s][0]
            if at is not None:
                f = f.withColumn(m, F.when(F.col("year").isin(sorted(at)), F.col(m)))
            if len(homes[m]) > 1:
                parts.setdefault(m, []).append(f"_{m}_{s}")
                f = f.withColumnRenamed(m, f"_{m}_{s}")
        out = out.join(unique_by_key(f), JOIN_KEYS, "left")
    if parts:
        out = out.withColumns({m: F.coalesce(*cs) for m, cs in parts.items()}) \
            .drop(*[c for cs in parts.values() for c in cs])
    absent = [m for m in measures if m not in out.columns]
    if absent:
        out = out.withColumns({m: F.lit(None).cast("decimal(16,2)") for m in absent})
    return out


def _area_keys(geo: DataFrame) -> DataFrame:
    if "stusab_key" in geo.columns:  # stored with the key, maybe bucketed by it
        return geo.select("year", "geoid", "stusab_key", "logrecno")
    return geo.select(F.col("year").cast("int").alias("year"), "geoid",
                      region_key().alias("stusab_key"), "logrecno")


def attach_area(data: DataFrame, geo: DataFrame, names) -> DataFrame:
    """RIGHT OUTER join of metric rows to the areas of their year.

    Every area row survives; region codes are compared in lower case. The
    year comes from the area side, so areas without data keep their year. A
    key repeated in ``data`` fails the job instead of repeating areas.
    """
    d = unique_by_key(_keyed(data).select(*JOIN_KEYS, *names)).alias("d")
    g = geo.select("year", "geoid", region_key().alias("stusab_key"), "logrecno").alias("g")
    cond = [F.col("d.year") == F.col("g.year"),
            F.col("d.stusab_key") == F.col("g.stusab_key"),
            F.col("d.logrecno") == F.col("g.logrecno")]
    return d.join(g, cond, "right").select(
        F.col("g.year").alias("year"), F.col("g.geoid").alias("geoid"),
        *[F.col(f"d.{n}").alias(n) for n in names])


def measure_sequences(lookup_rows) -> dict:
    """measure id → (sequence, ordinal); the lowest sequence wins."""
    out: dict = {}
    for r in lookup_rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        v, s, o = r["varid"], int(r["seq"]), int(r.get("ordinal") or 0)
        if v not in out or s < out[v][0]:
            out[v] = (s, o)
    return out


def measure_homes(measures, lookup_rows, missing: str = "raise") -> dict:
    """measure id → {sequence: (years or None, ordinal)}.

    Rows without a year hold for all years (None), the lowest sequence wins.
    With years, each year has its own home: the lowest sequence of its rows.
    """
    by_year: dict = {}
    for r in lookup_rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        by_year.setdefault(r.get("year"), []).append(r)
    out: dict = {}
    for year, rows in sorted(by_year.items(), key=lambda x: (x[0] is not None, x[0] or 0)):
        for m, (s, o) in measure_sequences(rows).items():
            if m not in measures:
                continue
            home = out.setdefault(m, {})
            if year is None:
                home[s] = (None, o)
            elif not any(at is None for at, _ in home.values()):
                home[s] = (home.get(s, (set(), o))[0] | {int(year)}, home.get(s, (None, o))[1])
    unknown = sorted(m for m in measures if m not in out)
    if unknown and missing == "raise":
        raise CatalogError(f"measures not in the lookup: {', '.join(unknown)}")
    return out


def group_frame(plan: GroupPlan, sequences: dict, lookup_rows, geo: DataFrame,
                missing: str = "raise") -> DataFrame:
    """One group's metrics for every area of every year in its window.

    The reference pattern (one temporary table per group): the group's
    sequences pruned and joined to the areas of the window years (every area
    row survives, as with the reference's right join), formulas selected.
    An empty window (first year after last) yields no rows.
    """
    names = [n for n, _ in plan.metrics]
    lo, hi = plan.first_year, plan.last_year
    areas = _area_keys(geo.filter(F.col("year").between(lo, hi)))
    data = areas_with_measures(areas, sequences, lookup_rows, plan.measures, (lo, hi), missing)
    return data.select("year", "geoid",
                       *[F.expr(sql).cast(plan.types[n]).alias(n) for n, sql in plan.metrics])


def _check_unique(src: DataFrame, key, cols) -> DataFrame:
    """Collapse ``src`` to one row per key; a repeated key fails the job."""
    agg = src.groupBy(*key).agg(*[F.first(c).alias(c) for c in cols],
                                F.count(F.lit(1)).alias("_n"))
    checked = agg.filter(F.when(F.col("_n") > 1, F.raise_error(
        F.lit("duplicate key on the source side of an upsert"))).otherwise(F.lit(True)))
    return checked.select(*key, *cols)


def _overwrite(fact: DataFrame, src: DataFrame, key, cols) -> DataFrame:
    """Cells of ``fact`` replaced by those of ``src`` (unique on ``key``) that are not NULL."""
    s = src.select(*key, *[F.col(c).alias(f"_s_{c}") for c in cols])
    joined = fact.join(s, key, "left")
    out = []
    for c in fact.columns:
        if c in cols:
            out.append(F.coalesce(F.col(f"_s_{c}"), F.col(c)).cast(fact.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    extra = [c for c in cols if c not in fact.columns]
    return joined.select(*out, *[F.col(f"_s_{c}").alias(c) for c in extra])


def upsert_fact(fact: DataFrame, src: DataFrame, key=("year", "geoid"),
                cols=None) -> DataFrame:
    """Overwrite fact cells with the source where the source is not NULL.

    One LEFT join and a ``coalesce`` per column replace one UPDATE per
    column. The source must be unique on ``key`` (checked in the plan).
    """
    key = list(key)
    cols = list(cols or [c for c in src.columns if c not in key])
    return _overwrite(fact, _check_unique(src, key, cols), key, cols)


def stacked_groups(plans, sequences: dict, lookup_rows, geo: DataFrame,
                   missing: str = "raise") -> DataFrame:
    """The frames of several groups in one: (year, area id, rank, metrics).

    The areas meet every needed sequence once; each area row then becomes one
    row per group whose window holds its year, NULL in the columns of other
    groups. ``rank`` is the group's place in the order of the upserts.
    """
    live = [p for p in plans if not p.empty]
    if not live:
        raise CatalogError("no group has a year to build")
    types: dict = {}
    for p in live:
        for n, _ in p.metrics:
            types.setdefault(n, p.types[n])
    lo, hi = min(p.first_year for p in live), max(p.last_year for p in live)
    areas = _area_keys(geo.filter(F.col("year").between(lo, hi)))
    measures = sorted({m for p in live for m in p.measures})
    data = areas_with_measures(areas, sequences, lookup_rows, measures, (lo, hi), missing)
    groups = []
    for i, p in enumerate(live):
        sql = dict(p.metrics)
        row = F.struct(F.lit(i).alias("rank"), *[
            (F.expr(sql[n]) if n in sql else F.lit(None)).cast(t).alias(n) for n, t in types.items()])
        groups.append(F.when(F.col("year").between(p.first_year, p.last_year), row))
    rows = F.filter(F.array(*groups), lambda g: g.isNotNull())
    return data.select("year", "geoid", F.inline(rows))


def upsert_ranked(fact: DataFrame, stacked: DataFrame, key=("year", "geoid"),
                  rank: str = "rank") -> DataFrame:
    """Several upserts in one: per cell the non-NULL value of the highest rank.

    The same rows as one :func:`upsert_fact` per rank in ascending order, with
    one aggregate and one join for any number of them. A key repeated within
    a rank fails the job. The rows are dealt by ``key`` first, so the ranks are
    counted where they lie, by hash aggregates only.
    """
    key = list(key)
    cols = [c for c in stacked.columns if c not in [*key, rank]]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(rank))).alias(c) for c in cols]
    agg = stacked.repartition(*key).groupBy(*key).agg(*last, F.count(F.lit(1)).alias("_n"),
                                                      F.count_distinct(rank).alias("_ranks"))
    checked = agg.filter(F.when(F.col("_n") > F.col("_ranks"), F.raise_error(
        F.lit("duplicate key on the source side of an upsert"))).otherwise(F.lit(True)))
    return _overwrite(fact, checked.select(*key, *cols), key, cols)


def empty_fact(spine: DataFrame, plans) -> DataFrame:
    """Fact skeleton: (year, area id) of the spine, every metric NULL."""
    types = {}
    for p in plans:
        for n, _ in p.metrics:
            types.setdefault(n, p.types[n])
    return spine.select(F.col("year").cast("int").alias("year"), "geoid",
                        *[F.lit(None).cast(t).alias(n) for n, t in types.items()])


MAX_FIELDS = 100  # fixed value: the default of spark.sql.codegen.maxFields


def metric_slices(plans, limit: int) -> list:
    """Metric names in slices whose measures, metrics and keys stay within ``limit`` fields.

    Metrics keep their order, so neighbours, which mostly share measures, stay
    together. A metric that alone needs more has a slice of its own.
    """
    needs: dict = {}
    for p in plans:
        for n, sql in p.metrics:
            ms = {unquoted(m) for m in names_of(sql)} & set(p.measures)
            needs.setdefault(n, set()).update(ms)
    out, measures = [], set()
    for n, ms in needs.items():
        room = len(JOIN_KEYS) + 1 + len(measures | ms) + (len(out[-1]) if out else 0) + 1
        if not out or room > limit:
            out.append([])
            measures = set()
        out[-1].append(n)
        measures |= ms
    return out


def _fact_columns(live, names, types) -> list:
    """Each metric: the latest group's value whose window holds the year."""
    yr, cols = F.col("year"), []
    for n in names:
        parts = []
        for p in reversed(live):
            sql = dict(p.metrics).get(n)
            if sql is not None:
                parts.append(F.when(yr.between(p.first_year, p.last_year), F.expr(sql)))
        val = parts[0] if len(parts) == 1 else F.coalesce(*parts) if parts else F.lit(None)
        cols.append(val.cast(types[n]).alias(n))
    return cols


def build_fact(geo: DataFrame, sequences: dict, lookup_rows, plans,
               missing: str = "raise", max_fields: int = MAX_FIELDS) -> DataFrame:
    """The wide fact table in one pass.

    All groups' measures are read once per sequence (only the needed
    columns) and left-joined to the areas on (year, region, record): one
    shuffle per sequence and one for the areas, whatever the number of
    sequences. Each metric column is then ``coalesce(group_n, …, group_1)``
    where a group's value counts only in its year window. Groups run in ascending name order and a later non-NULL
    value wins, as with one UPDATE per metric and group.

    A catalog whose measures and metrics are more than ``max_fields`` is
    computed in slices that Spark compiles (it does not compile a stage with
    more fields). Each slice keeps the areas' partitioning, so the slices are
    joined where they lie; an area's key must then be unique, which is checked.
    """
    live = [p for p in plans if not p.empty]
    types: dict = {}
    for p in plans:
        for n, _ in p.metrics:
            types.setdefault(n, p.types[n])
    areas = _area_keys(geo)
    if not live:
        return areas.select("year", "geoid", *[F.lit(None).cast(t).alias(n) for n, t in types.items()])
    lo = min(p.first_year for p in live)
    hi = max(p.last_year for p in live)
    slices = metric_slices(live, max_fields)
    if len(slices) > 1:
        areas = unique_by_key(areas, message="area key twice")
    out = None
    for names in slices:
        wanted = set(names)
        sqls = [sql for p in live for n, sql in p.metrics if n in wanted]
        used = {unquoted(m) for sql in sqls for m in names_of(sql)}
        measures = sorted({m for p in live for m in p.measures} & used)
        data = areas_with_measures(areas, sequences, lookup_rows, measures, (lo, hi), missing)
        part = data.select(*JOIN_KEYS, *(["geoid"] if out is None else []), *_fact_columns(live, names, types))
        out = part if out is None else out.join(part, JOIN_KEYS)
    rest = [F.lit(None).cast(t).alias(n) for n, t in types.items() if n not in out.columns]
    return out.select("*", *rest).select("year", "geoid", *types)
