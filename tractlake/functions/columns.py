"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen; nothing calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_left_keep(c, width: int, pad: str = "0") -> Column:
    """Left-pad to ``width``; longer values are kept whole.

    Plain ``lpad`` cuts values longer than ``width``; a record number of
    eight characters must survive unchanged.
    """
    s = col_of(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, pad)).otherwise(s)


def last_chars(c, n: int) -> Column:
    """The last ``n`` characters (the whole value when it is shorter)."""
    s = col_of(c)
    return F.when(F.length(s) <= n, s).otherwise(F.substring(s, -n, n))


def part_from_end(c, k: int, sep: str = ",", missing: str = "NA") -> Column:
    """The ``k``-th comma part counted from the end, or ``missing``.

    Blanks next to the separator are kept. ``try_element_at`` returns NULL
    out of range where ``element_at`` would raise under ANSI mode.
    """
    parts = F.split(col_of(c), sep, -1)
    return F.coalesce(F.try_element_at(parts, F.lit(-k)), F.lit(missing))


def blank_to_null(c) -> Column:
    """Empty text becomes NULL, as a staged CSV round trip does."""
    s = col_of(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def zero_pad_int(c, width: int) -> Column:
    """Integer rendered with at least ``width`` digits (``%04d``)."""
    return F.format_string(f"%0{width}d", col_of(c).cast("long"))


def batch_folder(ts, prefix: str) -> Column:
    """Landing folder of a notice: ``prefix`` + date as ``yyyyMMdd``."""
    return F.concat(F.lit(prefix), F.date_format(col_of(ts), "yyyyMMdd"))


def batch_date(path) -> Column:
    """Date encoded in the last eight characters of a landing folder."""
    return F.to_date(F.substring(col_of(path), -8, 8), "yyyyMMdd")


def file_suffix(name) -> Column:
    """Text after the last dot (the whole name when there is none)."""
    return F.element_at(F.split(col_of(name), r"\.", -1), -1)


def base_name(path) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(col_of(path), "/", -1), -1)


def date_after(ts, day: str) -> Column:
    """``to_date(ts) > day`` written as a range on the raw column.

    ``ts >= day + 1`` keeps the predicate on the stored column, so a
    parquet scan receives it as a pushed filter and skips row groups.
    """
    nxt = F.date_add(F.lit(day).cast("date"), 1)
    c = col_of(ts)
    return c >= nxt.cast("timestamp_ntz")
