"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def salted_lookup_join(big: DataFrame, small: DataFrame, keys, buckets: int = 16,
                       how: str = "inner", salt_on=None) -> DataFrame:
    """Join ``big`` to ``small`` (unique on ``keys``) with the hot keys split.

    Each row of ``big`` gets a salt in ``[0, buckets)`` from a hash of the
    ``salt_on`` columns (default: all non-key columns); each row of ``small``
    is repeated once per salt. The join on (keys, salt) then spreads one key's
    rows over ``buckets`` tasks instead of one. The salt is a pure function
    of the row, so a task recomputed after an executor loss sends every row
    to the same place again. ``small`` grows by ``buckets`` times, which is
    cheap because it has one row per key.
    """
    keys = list(keys)
    cols = list(salt_on or [c for c in big.columns if c not in keys])
    b = big.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int"))
    s = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, keys + [SALT], how).drop(SALT)
