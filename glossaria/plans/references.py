"""p3: references of the lemma map that do not resolve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossaria.operators.orphans import Reference, find_orphans, orphan_report
from glossaria.tables import table


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, list[Reference]]:
    rows = table(spark, sf, "lemma_map", "row_id", "key", "lemma", "loaded_at")
    refs = [
        Reference("key", table(spark, sf, "entry", "key", "added_at", "removed_at"), "key"),
        Reference("lemma", table(spark, sf, "package_dictionary", "lemma", "added_at", "removed_at"), "lemma"),
    ]
    return rows, refs


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    rows, refs = _parts(spark, sf)
    return find_orphans(rows, "row_id", "loaded_at", refs).select("row_id", "ref_field", "reason")


def p3_orphans_by_month(spark: SparkSession, sf: str) -> DataFrame:
    rows, refs = _parts(spark, sf)
    return orphan_report(rows, "row_id", "loaded_at", refs)


_FOUND = """
    SELECT m.row_id, '{f}' AS ref_field,
           CASE WHEN NOT EXISTS (SELECT 1 FROM {t} e WHERE e.{f} = m.{f}) THEN 'missing'
                WHEN NOT EXISTS (SELECT 1 FROM {t} e WHERE e.{f} = m.{f} AND e.added_at <= m.loaded_at) THEN 'late'
                ELSE 'deleted' END AS reason, m.loaded_at
    FROM lemma_map m
    WHERE m.{f} IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM {t} e WHERE e.{f} = m.{f} AND e.added_at <= m.loaded_at AND (e.removed_at IS NULL OR e.removed_at > m.loaded_at))
"""
_BOTH = _FOUND.format(f="key", t="entry") + " UNION ALL " + _FOUND.format(f="lemma", t="package_dictionary")

QUERIES = {"p3_found": p3_found, "p3_orphans_by_month": p3_orphans_by_month}
ORACLE = {
    "p3_found": f"SELECT row_id, ref_field, reason FROM ({_BOTH}) x",
    "p3_orphans_by_month": f"""
        WITH bad AS (
            SELECT ref_field, strftime(loaded_at, '%Y-%m') AS period,
                   sum(CASE WHEN reason = 'missing' THEN 1 ELSE 0 END) AS n_missing,
                   sum(CASE WHEN reason = 'late' THEN 1 ELSE 0 END) AS n_late,
                   sum(CASE WHEN reason = 'deleted' THEN 1 ELSE 0 END) AS n_deleted
            FROM ({_BOTH}) x GROUP BY ALL),
        totals AS (
            SELECT 'key' AS ref_field, strftime(loaded_at, '%Y-%m') AS period, count(*) AS n_refs FROM lemma_map WHERE key IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT 'lemma', strftime(loaded_at, '%Y-%m'), count(*) FROM lemma_map WHERE lemma IS NOT NULL GROUP BY ALL)
        SELECT t.ref_field, t.period, t.n_refs, CAST(coalesce(n_missing, 0) AS BIGINT) AS n_missing, CAST(coalesce(n_late, 0) AS BIGINT) AS n_late,
               CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted,
               round((coalesce(n_missing, 0) + coalesce(n_late, 0) + coalesce(n_deleted, 0)) / n_refs, 6) AS orphan_share
        FROM totals t LEFT JOIN bad b ON t.ref_field = b.ref_field AND t.period IS NOT DISTINCT FROM b.period""",
}
