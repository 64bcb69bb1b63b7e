"""A lookup join that stays even when one key holds a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_values(rows: DataFrame, key: str, parts: int = 256, least_rows: int = 10_000) -> list:
    """Values of ``key`` that hold at least ``1 / parts`` of the rows and ``least_rows``: at most ``parts`` of them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return [r[0] for r in counts.where(F.col("_n") >= max(total / parts, least_rows)).select(key).limit(parts).collect()]


def salt(parts: int) -> Column:
    """A number below ``parts`` that spreads the rows of one key, repeated rows included, over many tasks.

    It depends on where a row is read, not on a random number, so a task that runs again gives the same.
    """
    return F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")


def salted_join(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "left", parts: int = 64) -> DataFrame:
    """A join on equal ``keys`` in which the rows of one key spread over ``parts`` tasks; ``other`` is repeated as often.

    For the few keys that are known to be heavy: what is repeated is then small, and nothing is broadcast.
    """
    copies = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return rows.withColumn("_salt", salt(parts)).join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores if it has fewer partitions than there are cores: for small inputs that become large on the way."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def hot_hashes(counts: DataFrame, keys: list[str], n: str = "n", parts: int = 256, least_rows: int = 10_000) -> list[int]:
    """Hashes of the key values that hold at least ``1 / parts`` of all rows, and ``least_rows``, by ``counts``: at most ``parts``.

    A hash instead of a value, as values may be long texts.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    per = counts.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.sum(n).alias("_n")).where(F.col("_n") >= max(total / parts, least_rows))
    return [r[0] for r in per.select("_h").limit(parts).collect()]


def spread_join(rows: DataFrame, other: DataFrame, keys: list[str], how: str, hot: list[int], parts: int = 64) -> DataFrame:
    """A left, semi or anti join on equal ``keys`` that salts the rows whose keys' hash is in ``hot``; all others are joined as usual."""
    if not hot:
        return rows.join(other, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    usual = rows.where(~is_hot).join(other.where(~is_hot), keys, how)
    return usual.unionByName(salted_join(rows.where(is_hot), other.where(is_hot), keys, how, parts))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, parts: int = 256, least_rows: int = 10_000) -> DataFrame:
    """``rows`` left-joined with ``lookup`` (unique in ``key``), without ever gathering a heavy key.

    Rows of heavy keys (at most ``parts`` keys, by counting) are salted and meet as many copies of the few lookup rows
    they need; all others are joined by shuffle. Nothing is broadcast, so a lookup row may be of any length. Null keys match nothing.
    """
    heavy = heavy_values(rows, key, parts, least_rows)
    if not heavy:
        return rows.join(lookup, key, "left")
    is_heavy = F.col(key).isin(heavy)
    hot = lookup.where(is_heavy)
    rest = rows.where(F.col(key).isNull() | ~is_heavy)
    return salted_join(rows.where(is_heavy), hot, [key]).unionByName(rest.join(lookup, key, "left"))
