"""A join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame, right: DataFrame, on: str, *, spread_by: str, how: str = "left", salts: int = 4
) -> DataFrame:
    """Equi-join of a long left side to a right side with few rows per key.

    Adaptive execution broadcasts a right side that turns out small, and splits
    a skewed partition at run time, but it can split only where both sides come
    straight from the join's own shuffle; a right side just grouped on ``on`` is
    not shuffled again and loses that. Here left rows of one key are spread over
    ``salts`` values by a hash of ``spread_by`` (the same on a retried task) and
    right rows are listed once per value. So both sides are shuffled for the
    join, a hot key has ``salts`` tasks to begin with, and each of them can
    still be split. Nothing is counted or scanned first.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    joined = left.withColumn("_salt", salt).join(right.withColumn("_salt", each), [on, "_salt"], how)
    return joined.drop("_salt")
