"""Samples that are the same on every run and every cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key: Column, seed: int) -> Column:
    """A pseudo-random order that other engines can repeat."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """A uniform sample of ``n`` rows."""
    return df.orderBy(hash_order(F.col(key), seed), key).limit(n)


def oversample(df: DataFrame, key: str, n: int, keep: Column, by: float = 1.15, seed: int = 1) -> DataFrame:
    """``n`` rows by key out of a sample over all rows, ``by`` times as large, of which ``keep`` holds: what else is empty does not move it."""
    return hash_sample(df, key, int(n * by + 1e-9), seed).where(keep).orderBy(key).limit(n)


def systematic_sample(df: DataFrame, by: str, order: str, step: int, offset: int = 0) -> DataFrame:
    """Every ``step``-th row of each group in order, beginning at ``offset``."""
    row = F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    return df.withColumn("_row", row).where(F.col("_row") % step == offset).drop("_row")
