"""Comparison of two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, before, after, change)`` of keys that were added, removed or changed; null values compare equal to null.

    Both sides are unique in key. One full outer join; unchanged keys are dropped in it.
    """
    b = before.select(F.col(key).alias("_k1"), F.col(value).alias("before"), F.lit(1).alias("_b"))
    a = after.select(F.col(key).alias("_k2"), F.col(value).alias("after"), F.lit(1).alias("_a"))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return b.join(a, F.col("_k1") == F.col("_k2"), "full_outer").select(F.coalesce("_k1", "_k2").alias(key), "before", "after", change.alias("change")).where("change is not null")
