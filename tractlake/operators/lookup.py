"""Sequence templates → lookup table → typed sequence schemas; long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.operators.facts import FIXED_SEQ_COLUMNS, unique_by_key

MEASURE_TYPE = T.DecimalType(16, 2)
TEMPLATE_SKIP = 6


def unpivot_template(df: DataFrame, seq=None, skip: int = TEMPLATE_SKIP,
                     row_col: str | None = None, keep=()) -> DataFrame:
    """Columns → rows (varid, seq, label, ordinal); empty labels dropped.

    The first ``skip`` columns are not measures. ``seq`` is a literal
    sequence number or the name of a column holding it. ``ordinal`` is the
    measure's position among the measure columns (1-based), which is the
    column order of the sequence file. With ``row_col`` (the row order of
    the template) a measure labelled on two rows keeps its first label.
    The unpivot is one ``inline`` over an array of structs: a local Expand,
    no shuffle.
    """
    meta = {seq} if isinstance(seq, str) else set()
    meta.update(keep)
    if row_col:
        meta.add(row_col)
    cols = [c for c in df.columns[skip:] if c not in meta]
    cells = F.array(*[F.struct(F.lit(c).alias("varid"), F.lit(i).alias("ordinal"),
                               F.col(f"`{c}`").cast("string").alias("label"))
                      for i, c in enumerate(cols, 1)])
    seq_col = F.col(seq) if isinstance(seq, str) else F.lit(seq)
    extra = [F.col(k) for k in keep] + ([F.col(row_col)] if row_col else [])
    long = (df.select(*extra, seq_col.cast("int").alias("seq"), F.inline(cells))
            .filter(F.col("label").isNotNull()))
    if row_col:
        grp = [*keep, "seq", "varid", "ordinal"]
        long = long.groupBy(*grp).agg(F.min_by("label", row_col).alias("label"))
    return long.select(*keep, "varid", "seq", "label", "ordinal")


def build_lookup(templates) -> DataFrame:
    """All templates of a year stacked (each already unpivoted)."""
    out = templates[0]
    for t in templates[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def sequence_wide(lookup_rows, seq: int, year: int | None = None) -> T.StructType | None:
    """Typed schema of one sequence file, or ``None`` if it is not listed.

    Six fixed text columns, then one decimal per measure in ordinal order.
    Rows are lookup metadata collected by the caller (a few hundred); with
    ``year``, only that year's rows count.
    """
    ms = []
    seen = set()
    for r in lookup_rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        if year is not None and int(r["year"]) != int(year):
            continue
        if int(r["seq"]) == int(seq) and r["varid"] not in seen:
            seen.add(r["varid"])
            ms.append((int(r.get("ordinal") or 0), r["varid"]))
    if not ms:
        return None
    ms.sort()
    return T.StructType([T.StructField(c, T.StringType()) for c in FIXED_SEQ_COLUMNS]
                        + [T.StructField(v, MEASURE_TYPE) for _, v in ms])


def cast_sequence(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select a sequence's columns in schema order with the schema's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def measures_long(est: DataFrame, mar: DataFrame, measures,
                  keys=("year", "stusab", "logrecno")) -> DataFrame:
    """(keys, measure, estimate, margin) from twin estimate and margin tables.

    The wide tables are joined first (one row per key, far fewer rows than
    the long form) with a FULL OUTER join on coalesced keys, then each row is
    unpivoted locally into one row per measure. A key repeated inside one table
    fails the job; the check's aggregate is the join's shuffle.
    """
    keys = list(keys)
    e = est.select(*keys, *[F.col(m).alias(f"e_{m}") for m in measures])
    m = mar.select(*keys, *[F.col(x).alias(f"m_{x}") for x in measures])
    j = unique_by_key(e, keys).join(unique_by_key(m, keys), keys, "full")
    cells = F.array(*[F.struct(F.lit(x).alias("measure"), F.col(f"e_{x}").alias("estimate"),
                               F.col(f"m_{x}").alias("margin")) for x in measures])
    return j.select(*keys, F.inline(cells))
