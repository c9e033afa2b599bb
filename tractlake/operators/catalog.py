"""Metric catalog: table operators over catalog rows and the small planner
that turns catalog metadata into column expressions.

The catalog is metadata (a few hundred rows); the planner collects it once on
the driver to build one lazy plan. Every operator that answers a question
*about* the catalog is also available as a DataFrame operator, so it runs
distributed on a catalog of any size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.functions.columns import col_of
from tractlake.operators.formulas import (FormulaError, guard_division, guard_text, names_of, replace_names,
                                          unquoted)

# Open end year marker, statistics stored at six decimals, the
# two stored types, and the pattern that finds measure ids in a formula.
OPEN_END_YEAR = 9999
RATE_STATISTICS = ["rate", "percentage"]
RATE_TYPE = "decimal(9,6)"
COUNT_TYPE = "decimal(16,2)"
MEASURE_PATTERN = r"[BC]\w*_\w*"

CATALOG_COLUMNS = ["group_name", "metric_name", "formula", "statistic",
                   "start_year", "end_year", "notes"]



class CatalogError(ValueError):
    """The catalog cannot be turned into a plan."""


# ---------------------------------------------------------------- table ops

def close_open_years(cat: DataFrame, load_year: int) -> DataFrame:
    """End year 9999 (still published) becomes the load year."""
    return cat.withColumn(
        "end_year",
        F.when(F.col("end_year") == OPEN_END_YEAR, F.lit(load_year).cast("int"))
        .otherwise(F.col("end_year").cast("int")))


def measures_in(formula) -> Column:
    """Array of measure ids named by a formula."""
    return F.regexp_extract_all(col_of(formula), F.lit(MEASURE_PATTERN), 0)


def extract_measures(cat: DataFrame) -> DataFrame:
    """Distinct (group, measure) pairs used by the formulas of each group."""
    return (cat.select("group_name", F.explode(measures_in("formula")).alias("measure"))
            .distinct())


def group_windows(cat: DataFrame, load_year: int) -> DataFrame:
    """Per group: first year = max start year, last = min(max end, load)."""
    return (cat.groupBy("group_name")
            .agg(F.max("start_year").cast("int").alias("first_year"),
                 F.max("end_year").cast("int").alias("max_end"))
            .select("group_name", "first_year",
                    F.least(F.col("max_end"), F.lit(load_year)).cast("int").alias("last_year")))


def metric_type(statistic) -> Column:
    return (F.when(F.lower(F.trim(col_of(statistic))).isin(RATE_STATISTICS), F.lit(RATE_TYPE))
            .otherwise(F.lit(COUNT_TYPE)))


def metric_types(cat: DataFrame) -> DataFrame:
    """One stored type per metric name; two types for one name raise.

    The check is a filter that raises, so it runs whichever columns are read.
    """
    t = cat.select(F.lower(F.trim("metric_name")).alias("metric_name"),
                   metric_type("statistic").alias("col_type"))
    agg = t.groupBy("metric_name").agg(F.min("col_type").alias("col_type"),
                                       F.max("col_type").alias("_hi"))
    checked = agg.filter(F.when(
        F.col("col_type") != F.col("_hi"),
        F.raise_error(F.concat(F.lit("metric with two types: "), F.col("metric_name")))).otherwise(F.lit(True)))
    return checked.select("metric_name", "col_type")


def select_items(cat: DataFrame, ordinal="ordinal") -> DataFrame:
    """Each metric's select item (guarded formula AS name), with its place.

    The items of a group, ordered by the catalog ordinal, form that group's
    select list. Kept as rows, not concatenated, so no group is gathered
    into one task.
    """
    return cat.select(
        F.col("group_name"), F.col(ordinal),
        F.lower(F.trim("metric_name")).alias("metric_name"),
        F.concat(guard_division("formula"), F.lit(" as "),
                 F.lower(F.trim("metric_name"))).alias("select_item"))


def _of_year(lookup: DataFrame, year: int | None) -> DataFrame:
    return lookup if year is None else lookup.filter(F.col("year") == year)


def group_sequences(lookup: DataFrame, measures, year: int | None = None) -> DataFrame:
    """Distinct sequences holding any of ``measures`` (in the lookup of ``year``)."""
    return (_of_year(lookup, year).filter(F.col("varid").isin(list(measures)))
            .select("seq").distinct())


def sequence_measures(lookup: DataFrame, measures, seq: int | None = None, year: int | None = None) -> DataFrame:
    """The given measures that live in one sequence, in column order.

    Without ``seq``: those of every sequence, as (seq, varid, ordinal).
    ``measures`` is a list of ids or a table with a ``varid`` column.
    """
    rows = _of_year(lookup, year)
    if isinstance(measures, DataFrame):
        rows = rows.join(measures.select("varid").distinct(), "varid", "left_semi")
    else:
        rows = rows.filter(F.col("varid").isin(list(measures)))
    if seq is None:
        return rows.select("seq", "varid", "ordinal")
    return rows.filter(F.col("seq") == seq).select("varid", "ordinal")


# ------------------------------------------------------------------ planner

@dataclass
class GroupPlan:
    name: str
    first_year: int
    last_year: int
    metrics: list = field(default_factory=list)      # [(name, expanded sql)]
    measures: list = field(default_factory=list)     # sorted distinct ids
    types: dict = field(default_factory=dict)        # name -> type

    @property
    def empty(self) -> bool:
        return self.first_year > self.last_year


def _expand(formula: str, known: dict, group: str, metric: str) -> str:
    """Replace references to earlier metrics of the group by their text.

    A name defined earlier in the group, in whatever case, is that metric even
    where it looks like a measure id; other measure ids stay (quoted ones in
    Spark's quotes), and anything else is an error.
    """
    def new(name, text):
        if name.lower() in known:
            return f"({known[name.lower()]})"
        if re.fullmatch(MEASURE_PATTERN, name):
            return name if text == name else f"`{name}`"
        if text.lower() == "null":
            return text
        raise CatalogError(
            f"group {group!r}, metric {metric!r}: unknown name {name!r} "
            "(names may only refer to metrics defined earlier in the group)")
    return replace_names(formula, new)


def plan_groups(rows, load_year: int, year_override: tuple | None = None) -> list:
    """Plans of all groups in ascending group name.

    ``rows`` are catalog rows (dicts or Rows) in catalog order. Names are
    trimmed and folded to lower case; formulas are guarded and chained names
    expanded. ``year_override`` = (first, last) replaces every window.
    """
    by_group: dict = {}
    types: dict = {}
    for r in rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        g = str(r["group_name"]).strip().lower()
        name = str(r["metric_name"]).strip().lower()
        t = RATE_TYPE if str(r["statistic"]).strip().lower() in RATE_STATISTICS else COUNT_TYPE
        if types.setdefault(name, t) != t:
            raise CatalogError(f"metric {name!r} has two types: {types[name]} and {t}")
        by_group.setdefault(g, []).append((name, str(r["formula"]), int(r["start_year"]),
                                           int(r["end_year"])))
    plans = []
    for g in sorted(by_group):
        items = by_group[g]
        first = max(i[2] for i in items)
        end = max(i[3] for i in items)
        last = min(load_year if end == OPEN_END_YEAR else end, load_year)
        if year_override is not None:
            first, last = year_override
        known: dict = {}
        metrics, measures = [], set()
        for name, formula, _, _ in items:
            try:
                sql = _expand(guard_text(formula), known, g, name)
            except FormulaError as e:
                raise CatalogError(f"group {g!r}, metric {name!r}: {e}") from e
            measures.update(m for m in map(unquoted, names_of(sql)) if re.fullmatch(MEASURE_PATTERN, m))
            known[name] = sql
            metrics.append((name, sql))
        plans.append(GroupPlan(g, first, last, metrics, sorted(measures),
                               {n: types[n] for n, _ in metrics}))
    return plans
