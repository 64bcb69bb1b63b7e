"""References to records that are missing, deleted or not there yet.

The reference side may be skewed without limit: one key may hold a third of all rows. The work is
split by what the counts say:

1. References are pre-aggregated per key and period; partial sums leave each map task, so the
   shuffle carries one row per key and period, not one per reference. From this come the heavy
   keys: those with at least ``1 / heavy_parts`` of all references. By counting there can be at
   most ``heavy_parts`` of them, whatever the data.
2. Rows of heavy keys never move while their life spans are few (their number is checked): the spans are
   broadcast. Beyond that number the rows are salted and the spans repeated, so no key is gathered either way.
3. All other rows meet the target's life spans in a shuffled anti-join on the key.
4. Orphans of both ways are united, and only they are looked up once more for the reason.

Life spans of a key are merged first (repeated target rows, touching and overlapping spans become
one), so a reference meets at most one span and no row is multiplied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossaria.operators.skew import salt
from glossaria.workspace import materialise

FOREVER = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Reference:
    """Column ``field`` of the referring table names ``target_key`` of ``target``."""

    field: str
    target: DataFrame
    target_key: str
    added: str = "added_at"
    removed: str = "removed_at"


def life_spans(target: DataFrame, key: str, added: str = "added_at", removed: str = "removed_at") -> DataFrame:
    """Disjoint spans ``(_ref, _from, _to)`` in which a key has a live row; ``_to`` is exclusive.

    A null end means for ever. Rows with a null key or a null start name nothing that can be live and
    are left out; spans that end before they begin or at their begin are empty and left out as well.
    """
    rows = (
        target.select(
            F.col(key).cast("string").alias("_ref"),
            F.col(added).cast("timestamp_ntz").alias("_from"),
            F.coalesce(F.col(removed).cast("timestamp_ntz"), F.lit(FOREVER).cast("timestamp_ntz")).alias("_to"),
        )
        .where("_ref is not null and _from is not null and _to > _from")
        .distinct()
    )
    by_start = Window.partitionBy("_ref").orderBy("_from", "_to")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    new = F.when(F.col("_from") > F.max("_to").over(before), 1).when(F.max("_to").over(before).isNull(), 1).otherwise(0)
    return (
        rows.withColumn("_new", new)
        .withColumn("_span", F.sum("_new").over(by_start))
        .groupBy("_ref", "_span")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .drop("_span")
    )


def _first_seen(target: DataFrame, key: str, added: str) -> DataFrame:
    return (
        target.select(F.col(key).cast("string").alias("_ref"), F.col(added).cast("timestamp_ntz").alias("_added"))
        .where("_ref is not null")
        .groupBy("_ref")
        .agg(F.min("_added").alias("_first"))
    )


def reference_counts(rows: DataFrame, field: str, at: str, period: str = "month") -> DataFrame:
    """Number of references ``(_ref, _period, _n)`` per key and period of ``at``; null references don't count."""
    return (
        rows.where(F.col(field).isNotNull())
        .groupBy(F.col(field).cast("string").alias("_ref"), F.date_trunc(period, F.col(at)).alias("_period"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def heavy_keys(counts: DataFrame, heavy_parts: int = 256, least_rows: int = 10_000) -> list[str]:
    """Keys with at least ``1 / heavy_parts`` of all references and ``least_rows`` of them: never more than ``heavy_parts``."""
    per_key = counts.groupBy("_ref").agg(F.sum("_n").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    floor = max(total / heavy_parts, least_rows)
    found = [r[0] for r in per_key.where(F.col("_n") >= floor).select("_ref").limit(heavy_parts + 1).collect()]
    if len(found) > heavy_parts:  # cannot happen: so many keys would hold more than all rows
        raise AssertionError("more heavy keys than their share allows")
    return found


def _anti(rows: DataFrame, spans: DataFrame) -> DataFrame:
    live = (rows["_ref"] == spans["_ref"]) & (spans["_from"] <= rows["_at"]) & (rows["_at"] < spans["_to"])
    return rows.join(spans, live, "left_anti")


def _salted_anti(rows: DataFrame, spans: DataFrame, parts: int = 64) -> DataFrame:
    """As :func:`_anti` for heavy keys with many spans: the rows of a key go to ``parts`` tasks, its spans to each of them."""
    rows = rows.withColumn("_salt", salt(parts))
    copies = spans.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).hint("merge")
    live = (rows["_ref"] == copies["_ref"]) & (rows["_salt"] == copies["_salt"]) & (copies["_from"] <= rows["_at"]) & (rows["_at"] < copies["_to"])
    return rows.join(copies, live, "left_anti").drop("_salt")


def find_orphans(rows: DataFrame, row_id: str, at: str, refs: list[Reference], heavy_parts: int = 256, least_rows: int = 10_000, most_broadcast: int = 16_384) -> DataFrame:
    """One row ``(row_id, ref_field, _ref, _at, reason)`` for each non-null reference without a live target at ``at``.

    reason: 'missing' if no target row has the value, 'late' if every target row was added after ``at``,
    otherwise 'deleted'. Values are compared as exact strings (an empty string is a value). A null
    reference is no case; a null ``at`` lies in no life span, so such a reference is reported, as
    'missing' or 'deleted'. Repeated referring rows each count. Empty tables on either side are fine.
    Other columns of either side are never read.
    """
    spark = rows.sparkSession
    out = None
    for ref in refs:
        wanted = rows.where(F.col(ref.field).isNotNull()).select(
            F.col(row_id).alias("row_id"), F.col(ref.field).cast("string").alias("_ref"), F.col(at).cast("timestamp_ntz").alias("_at")
        )
        # read by two joins and a count: written once
        spans = materialise(life_spans(ref.target, ref.target_key, ref.added, ref.removed), "spans")
        heavy = heavy_keys(reference_counts(rows, ref.field, at), heavy_parts, least_rows)
        if heavy:
            keys = spark.createDataFrame([(k,) for k in heavy], "_ref string")
            hot_spans = spans.join(F.broadcast(keys), "_ref", "left_semi")
            n_spans = hot_spans.limit(most_broadcast + 1).count()
            is_hot = F.col("_ref").isin(heavy)
            hot = wanted.where(is_hot)
            hot = _anti(hot, F.broadcast(hot_spans)) if n_spans <= most_broadcast else _salted_anti(hot, hot_spans)
            orphans = _anti(wanted.where(~is_hot), spans).unionByName(hot)
        else:
            orphans = _anti(wanted, spans)
        first = _first_seen(ref.target, ref.target_key, ref.added)
        # a heavy key without target would make one hot group in this lookup as well
        if heavy:
            keys = spark.createDataFrame([(k,) for k in heavy], "_ref string")
            hot_first = first.join(F.broadcast(keys), "_ref", "left_semi")
            orphans = (
                orphans.where(~is_hot).join(first, "_ref", "left").unionByName(orphans.where(is_hot).join(F.broadcast(hot_first), "_ref", "left"))
            )
        else:
            orphans = orphans.join(first, "_ref", "left")
        orphans = orphans.select(
            "row_id",
            F.lit(ref.field).alias("ref_field"),
            "_ref",
            "_at",
            F.when(F.col("_first").isNull(), "missing").when(F.col("_first") > F.col("_at"), "late").otherwise("deleted").alias("reason"),
        )
        out = orphans if out is None else out.unionByName(orphans)
    return out


def orphan_report(rows: DataFrame, row_id: str, at: str, refs: list[Reference], period: str = "month", **how: int) -> DataFrame:
    """Counts per referring field and period: references, orphans by reason, and the share of orphans."""
    totals = None
    for ref in refs:
        part = reference_counts(rows, ref.field, at, period).groupBy("_period").agg(F.sum("_n").alias("n_refs")).withColumn("ref_field", F.lit(ref.field))
        totals = part if totals is None else totals.unionByName(part)
    bad = (
        find_orphans(rows, row_id, at, refs, **how)
        .groupBy("ref_field", F.date_trunc(period, F.col("_at")).alias("_period"))
        .agg(*[F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("missing", "late", "deleted")])
    )
    same = (totals["ref_field"] == bad["ref_field"]) & totals["_period"].eqNullSafe(bad["_period"])
    n = [F.coalesce(F.col(f"n_{r}"), F.lit(0)).cast("bigint").alias(f"n_{r}") for r in ("missing", "late", "deleted")]
    return (
        totals.join(bad, same, "left")
        .select(totals["ref_field"], F.date_format(totals["_period"], "yyyy-MM").alias("period"), "n_refs", *n)
        .withColumn("orphan_share", F.round((F.col("n_missing") + F.col("n_late") + F.col("n_deleted")) / F.col("n_refs"), 6))
    )
