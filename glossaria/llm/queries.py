"""The pN_ queries of the operators for training data, and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.confusables import consistent
from glossaria.llm.mixing import mix_report, pareto_mix
from glossaria.llm.packing import check_packing, fill_report, pack
from glossaria.llm.pairs import find_defects
from glossaria.llm.pii import find_pii, redact
from glossaria.llm.tokens import count_tokens
from glossaria.llm.topn import cluster_by_group, clusterable, row_groups_read, top_n
from glossaria.llm.truncation import find_truncated, truncation_rates
from glossaria.tables import table
from glossaria.workspace import materialise


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """Glosses and answers as ``(tab, row_id, source, owner, text)``; the owner is the article the text is about."""
    glosses = table(spark, sf, "lemma_map").select(
        F.lit("lemma_map").alias("tab"), "row_id", "source", F.coalesce("key", "lemma").alias("owner"), F.col("gloss").alias("text")
    )
    answers = table(spark, sf, "freqfix_fw_headings2_ckpt").select(
        F.lit("freqfix_fw_headings2_ckpt").alias("tab"), F.col("rec_id").alias("row_id"), F.col("run").alias("source"), F.col("i").cast("string").alias("owner"), F.col("g").alias("text")
    )
    return glosses.unionByName(answers)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_truncated(_texts(spark, sf)).select("tab", "row_id")


def p1_rates(spark: SparkSession, sf: str) -> DataFrame:
    return truncation_rates(_texts(spark, sf))


def p1_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Cut records by the test that found them."""
    return find_truncated(_texts(spark, sf)).groupBy("tab", "test").agg(F.count(F.lit(1)).alias("n"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lemma_map", "row_id", "form", "headword")
    fields = [F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("form", "headword")]
    long = rows.select("row_id", F.explode(F.array(*fields)).alias("v")).select("row_id", "v.field", "v.value")
    return long.where(F.col("value") != consistent(F.col("value"))).select("row_id", "field")


def p2_consistent(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lemma_map", "row_id", "form", "headword")
    return rows.select("row_id", consistent(F.col("form")).alias("form"), consistent(F.col("headword")).alias("headword"))


def _defects(spark: SparkSession, sf: str) -> DataFrame:
    answers = table(spark, sf, "freqfix_fw_headings2_ckpt").select("rec_id", F.col("i").alias("idx"), F.col("g").alias("text"), "run")
    glosses = table(spark, sf, "lemma_map").select(F.coalesce("key", "lemma").alias("owner"), F.col("gloss").alias("text"))
    return find_defects(answers, table(spark, sf, "entry", "idx", "headword", "body"), table(spark, sf, "prompt_text", "body"), glosses)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _defects(spark, sf).select("rec_id", "defect")


def p4_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Answers by defect and, if truncated, by what found them."""
    return _defects(spark, sf).groupBy("defect", "by").agg(F.count(F.lit(1)).alias("n"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(table(spark, sf, "lemma_map", "row_id", "form", "lemma", "freq"), "lemma", "form", "freq", "row_id").select("row_id")


def p5_row_groups(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the clustered row groups, and of their rows, p5_found reads."""
    rows = clusterable(table(spark, sf, "lemma_map", "row_id", "form", "lemma", "freq"), "lemma", "form", "freq", "row_id")
    return row_groups_read(spark, cluster_by_group(rows), 3)


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of all documents in tokens, counted once."""
    return materialise(count_tokens(table(spark, sf, "documents", "doc_id", "source", "text"), "text", ["doc_id", "source"]), "sizes")


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    return pack(_sizes(spark, sf), table(spark, sf, "pack_spec"))


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    specs = table(spark, sf, "pack_spec")
    return fill_report(pack(_sizes(spark, sf), specs), specs)


def p6_check(spark: SparkSession, sf: str) -> DataFrame:
    sizes, specs = _sizes(spark, sf), table(spark, sf, "pack_spec")
    return check_packing(materialise(pack(sizes, specs), "packed"), sizes, specs)


def p7_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per target: whether no record is used too often and the share reached is within half a hundredth of what the targets with text ask for."""
    targets = table(spark, sf, "mix_target")
    rows = mix_report(pareto_mix(_sizes(spark, sf), targets), targets)
    wanted = F.try_divide(F.when(F.col("n_tokens") > 0, F.col("target_share")), F.sum(F.when(F.col("n_tokens") > 0, F.col("target_share"))).over(Window.partitionBy()))
    return rows.select("source", (F.col("most_copies") <= F.col("max_repeats")).alias("in_bounds"), (F.abs(F.col("actual_share") - wanted) < 0.005).alias("near"))


def p7_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return pareto_mix(_sizes(spark, sf), table(spark, sf, "mix_target"))


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_target")
    return mix_report(pareto_mix(_sizes(spark, sf), targets), targets)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return find_pii(docs, "doc_id", "text", table(spark, sf, "name_list")).select("doc_id", "pii_type", "start_pos")


def p8_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return redact(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", table(spark, sf, "name_list"))


QUERIES = {"p1_found": p1_found, "p1_rates": p1_rates, "p1_tests": p1_tests, "p2_found": p2_found, "p2_consistent": p2_consistent, "p4_found": p4_found, "p4_evidence": p4_evidence, "p5_found": p5_found, "p5_row_groups": p5_row_groups,
    "p6_packed": p6_packed,
    "p6_fill": p6_fill,
    "p6_check": p6_check,
    "p7_check": p7_check,
    "p7_mixed": p7_mixed,
    "p7_shares": p7_shares,
    "p8_found": p8_found, "p8_redacted": p8_redacted}
ORACLE = {
    "p6_check": "SELECT spec_id, (SELECT count(*) FROM documents) AS n_items, CAST(0 AS BIGINT) AS n_over, CAST(0 AS BIGINT) AS n_divided, CAST(0 AS BIGINT) AS n_wrong FROM pack_spec",
    "p7_check": "SELECT source, true AS in_bounds, true AS near FROM mix_target",
    "p5_found": """
        WITH once AS (
            SELECT row_id, lemma, form, freq, row_number() OVER (PARTITION BY lemma, form ORDER BY freq DESC, row_id) AS k
            FROM lemma_map WHERE lemma IS NOT NULL AND freq IS NOT NULL AND form IS NOT NULL),
        ranked AS (SELECT row_id, row_number() OVER (PARTITION BY lemma ORDER BY freq DESC, form) AS r FROM once WHERE k = 1)
        SELECT row_id FROM ranked WHERE r <= 3""",
}
