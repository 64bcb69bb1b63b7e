"""Choices made when a package is put together: the primary sense, the leading lemma, joined forms, and its check against gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaria.functions.readings import SLOTS, compatible, slot_of

#: Score of a sense that nobody judged.
UNSCORED = 3


def primary_senses(senses: DataFrame, decisive: Column | None = None) -> DataFrame:
    """``(lemma, idx, n)``: the senses a lemma ships, numbered from 1; lemmas whose primary sense is excluded ship none.

    ``senses (lemma, idx, gloss, pointer, size, score, seen, bad, is_function)``. Pointers come last; then long articles first,
    good scores first, short glosses first, and the index decides ties. Where ``decisive`` holds, how often a sense
    was seen in annotated texts comes before the length. An excluded function word at the head makes way for the next
    sense that isn't excluded, unless it is seen more often than that one.
    """
    seen = F.when(F.coalesce(decisive, F.lit(False)), -F.col("seen")).otherwise(0) if decisive is not None else F.lit(0)
    order = [F.col("pointer").cast("int"), seen, -F.col("size"), -F.coalesce("score", F.lit(UNSCORED)), F.length("gloss"), F.col("idx")]
    by = Window.partitionBy("lemma").orderBy(*order)
    after = by.rowsBetween(1, Window.unboundedFollowing)
    rank = F.row_number().over(by)
    next_seen = F.first(F.when(~F.col("bad"), F.col("seen")), ignorenulls=True).over(after)
    # makes way: seen from each sense on its own, so the first that doesn't is the head the senses end up with
    gives_way = F.col("bad") & F.col("is_function") & next_seen.isNotNull() & (F.col("seen") <= next_seen)
    ranked = senses.withColumn("_rank", rank).withColumn("_head", ~F.coalesce(gives_way, F.lit(False)))
    head = F.min(F.when(F.col("_head"), F.struct("_rank", "bad"))).over(Window.partitionBy("lemma"))
    kept = ranked.withColumn("_h", head).where((F.col("_rank") >= F.col("_h._rank")) & ~F.col("_h.bad") & ~F.col("bad"))
    return kept.select("lemma", "idx", F.row_number().over(Window.partitionBy("lemma").orderBy("_rank")).alias("n"))


def lead_by_majority(candidates: DataFrame, votes: DataFrame, targets: DataFrame, least: int = 5) -> DataFrame:
    """``(form, lemma, conf)``: candidates after the annotators' majority has spoken.

    ``candidates (form, lemma, bare, conf)``, ``votes (form, bare, n)`` and ``targets (bare, target)``, which lemma a pointer
    leads to. A bare lemma with two thirds of at least ``least`` votes is a form's majority. If candidates have it,
    the lemma itself leads with 1.0, its numbered namesakes follow with 0.99, and no other has more than 0.89. If
    none has, only candidates that point at it stay.
    """
    total = votes.groupBy("form").agg(F.sum("n").alias("total"))
    major = votes.join(total, "form").where((F.col("total") >= least) & (3 * F.col("n") >= 2 * F.col("total"))).select("form", F.col("bare").alias("major"))
    rows = candidates.join(major, "form", "left").withColumn("is_major", F.coalesce(F.col("bare") == F.col("major"), F.lit(False)))
    rows = rows.withColumn("has", F.max("is_major").over(Window.partitionBy("form")))
    points = targets.select("bare", F.col("target").alias("major")).distinct().withColumn("points", F.lit(True))
    rows = rows.join(points, ["bare", "major"], "left")
    conf = F.when(F.col("lemma") == F.col("major"), 1.0).when(F.col("is_major"), 0.99).when(F.col("has") & F.col("major").isNotNull(), F.least("conf", F.lit(0.89))).otherwise(F.col("conf"))
    return rows.where(F.col("major").isNull() | F.col("has") | F.col("points")).select("form", "lemma", conf.alias("conf"))


def drop_orphaned(rows: DataFrame, k: int = 3) -> DataFrame:
    """Rows ``(form, lemma, conf, ord, host, is_head)`` without joined forms whose host does not ship with the same lemma.

    ``host`` is the form an enclitic was joined to, null for all others and for the enclitic's own row, whose lemma is
    null. What ships is the first ``k`` per form before anything is dropped. A form of which only the enclitic's row is left goes too,
    unless it is a headword.
    """
    rank = F.row_number().over(Window.partitionBy("form").orderBy(F.col("conf").desc(), "ord"))
    shipped = rows.withColumn("_r", rank).where((F.col("_r") <= k) & F.col("lemma").isNotNull()).select(F.col("form").alias("host"), "lemma").distinct()
    kept = rows.where("host is null").unionByName(rows.where("host is not null").join(shipped, ["host", "lemma"], "left_semi").select(*rows.columns))
    some = F.max(F.col("lemma").isNotNull()).over(Window.partitionBy("form"))
    return kept.withColumn("_some", some).where("_some or is_head").drop("_some")


def against_gold(gold: DataFrame, package: DataFrame) -> DataFrame:
    """``gold (form, lemma, reading, n)`` with ``cell`` and ``outcome`` against ``package (form, lemma, cell)``, unique in form and lemma.

    Outcomes: 'form not indexed', 'lemma not offered', 'no reading offered', 'exact', 'compatible', 'contradicted'. A clitic
    is no part of a reading.
    """
    forms = package.select("form").distinct().withColumn("_form", F.lit(True))
    rows = gold.join(forms, "form", "left").join(package.select("form", "lemma", "cell"), ["form", "lemma"], "left")
    plain = F.transform(F.split("cell", r"\|"), lambda r: F.trim(F.regexp_replace(r, r"\benclitic\b", "")))
    outcome = (
        F.when(F.col("_form").isNull(), "form not indexed")
        .when(F.col("cell").isNull(), "lemma not offered")
        .when(F.col("cell") == "", "no reading offered")
        .when(F.array_contains(plain, F.col("reading")), "exact")
        .when(F.exists(plain, lambda r: compatible(r, F.col("reading"))), "compatible")
        .otherwise("contradicted")
    )
    return rows.select("form", "lemma", "reading", "n", "cell", outcome.alias("outcome"))


def slot_disagreements(judged: DataFrame) -> DataFrame:
    """``(slot, ours, gold, n)``: in which slots the first reading of contradicted cells differs; ours is null where it says nothing."""
    first = F.substring_index("cell", "|", 1)
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), slot_of(first, s).alias("ours"), slot_of(F.col("reading"), s).alias("gold")) for s in SLOTS if s != "clitic"])
    rows = judged.where("outcome = 'contradicted'").select("n", F.explode(slots).alias("s")).select("n", "s.*")
    return rows.where("gold is not null and (ours is null or ours != gold)").groupBy("slot", "ours", "gold").agg(F.sum("n").alias("n"))


def positional_zip(left: DataFrame, right: DataFrame, idx: str = "idx") -> DataFrame:
    """Rows of equal position side by side; a position that only one side has is an error, not a lost row."""
    a, b = left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1))
    both = a.join(b, idx, "full")
    lone = F.col("_l").isNull() | F.col("_r").isNull()
    checked = F.when(lone, F.raise_error(F.concat(F.lit("no counterpart at "), F.col(idx).cast("string")))).otherwise(F.col(idx))
    return both.withColumn(idx, checked).drop("_l", "_r")
