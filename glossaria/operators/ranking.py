"""Ranking of candidates and homographs. Every order is total, so results don't depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int = 3, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per group. The filter on the row number limits each map task to k rows per group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def numbered_names(df: DataFrame, by: str, order: list[Column], name: str = "name") -> DataFrame:
    """Homographs in order: the first keeps the bare name, the n-th gets n appended."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("rank", rank).withColumn(name, F.concat(F.col(by), F.when(F.col("rank") > 1, F.col("rank").cast("string")).otherwise("")))


def keep_best(df: DataFrame, by: list[str], score: str, arrival: str, values: list[str], *more: Column) -> DataFrame:
    """Per group the values of the greatest score, of equals the one that arrived first; ``more`` are further aggregates of the group."""
    best = F.max_by(F.struct(*values, score), F.struct(F.col(score), -F.col(arrival)))
    rows = df.groupBy(*by).agg(best.alias("b"), *more)
    return rows.select(*by, "b.*", *[c for c in rows.columns if c not in (*by, "b")])


def frequency_weight(n: Column) -> Column:
    """From 0.5 for unseen to 1.0 for ten thousand or more: 0.5 + 0.5 * min(1, log10(n + 1) / 4)."""
    return 0.5 + 0.5 * F.least(F.lit(1.0), F.log10(F.coalesce(n, F.lit(0)) + 1) / 4)


def confidence(origin: Column, share: Column, form: Column, n: Column) -> Column:
    """Confidence of a candidate by where it comes from: a fixed base, for some weighted by frequency, at most 1."""
    weight = frequency_weight(n)
    value = (
        F.when(origin == "headword", F.lit(1.0))
        .when(origin == "treebank", 0.90 + 0.09 * share)
        .when(origin == "rules", F.when(F.length(form) < 5, 0.35).otherwise(0.85) * weight)
        .when(origin == "host", 0.75 * weight)
        .when(origin == "enclitic", F.lit(0.30))
        .otherwise(0.5 * weight)
    )
    return F.least(value, F.lit(1.0))


def majority_leads(df: DataFrame, by: str, lemma: str, support: str, conf: str, least: int = 5) -> DataFrame:
    """If one lemma has two thirds of a form's support (and ``least`` of it) it leads with 1.0 and others stay below 0.9."""
    total = F.sum(support).over(Window.partitionBy(by))
    leads = (F.col(support) * 3 >= total * 2) & (total >= least)
    led = F.max(leads.cast("int")).over(Window.partitionBy(by))
    return df.withColumn("_leads", leads).withColumn("_led", led).withColumn(conf, F.when(F.col("_leads"), 1.0).when(F.col("_led") == 1, F.least(F.col(conf), F.lit(0.89))).otherwise(F.col(conf))).drop("_leads", "_led")


def frequency_band(df: DataFrame, score: str, tie: str, skip: int, top: int) -> DataFrame:
    """Rows ``skip`` .. ``skip + top`` of the order by score, then tie, both descending: a limit, not a sort of everything."""
    return df.orderBy(F.col(score).desc(), F.col(tie).desc()).offset(skip).limit(top)
