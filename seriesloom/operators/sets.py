"""Bag and set operations that differ from the SQL ones of the same name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subtract_bag(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left row whose value is absent on the right; left duplicates stay.

    ``subtract`` would remove duplicates and ``exceptAll`` would cancel one copy
    per match.
    """
    condition = F.lit(True)
    for name in left.columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return left.join(right.distinct(), condition, "left_anti")


def skewed_outer_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Left or full outer join on ``key`` for sides that may have crowded keys.

    The inner part can be split at crowded keys on either side; the rows without a partner are found against
    one row per key, which is aggregated before the shuffle.  NULL keys have no partner.
    """
    if how not in ("left", "full"):
        raise ValueError("how must be left or full")

    def alone(rows: DataFrame, others: DataFrame) -> DataFrame:
        return rows.join(others.select(key).distinct(), key, "left_anti")

    out = left.join(right, key).unionByName(alone(left, right), allowMissingColumns=True)
    return out.unionByName(alone(right, left), allowMissingColumns=True) if how == "full" else out
