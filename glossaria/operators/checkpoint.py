"""The result log: append-only lines of which the latest per key counts, and what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Per key the values of the last line written. A partial maximum leaves each map task, however often a key repeats."""
    return log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order)).alias("_v"), F.max(order).alias(order)).select(*keys, order, "_v.*")


def still_valid(recorded: Column, current: Column) -> Column:
    """A record holds if its input is the present one, or if it recorded none."""
    return recorded.isNull() | recorded.eqNullSafe(current)


def todo(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that have no valid result yet; failures were never written, so they come again."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")
