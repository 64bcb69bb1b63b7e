"""Glosses in stages: each stage looks at a row's gloss and source as the last one left them and may overwrite both.

Rows are ``(idx, headword, body, gloss, source)``. What a model would answer comes from a log, pivoted to one row per article
with a column per pass, so all stages but the taking over along pointers are projections after one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.functions import names, quality, text
from glossaria.functions.normalize import letters
from glossaria.functions.text import clean_glosses, enforce_cap, words
from glossaria.operators.judging import carried, mark_once, shorten_accepted
from glossaria.workspace import materialise

# Answers that decline; sources whose glosses a model wrote from the article; the source of the article's own words.
DECLINED = ["XREF", "NONE"]
WRITTEN = ["model", "repaired", "hard", "hard2", "named"]
OWN = "ls"


def answers_by_pass(log: DataFrame, passes: list[str]) -> DataFrame:
    """``(idx, <pass>...)``: the last answer of each pass to each article, of ``(idx, p, answer, at)``; empty answers never count."""
    rows = log.where(F.trim("answer") != "")
    return rows.groupBy("idx").agg(*[F.max_by("answer", F.when(F.col("p") == p, F.col("at"))).alias(p) for p in passes])


def classify(entries: DataFrame, translation: Column | None = None) -> DataFrame:
    """Rows at the start: ``tr`` with the printed translation if it is asked for and has one to five words, ``xref`` for pointers, else ``model``."""
    short = F.coalesce(F.size(words(translation)).between(1, 5), F.lit(False)) if translation is not None else F.lit(False)
    source = F.when(short, "tr").when(names.is_pointer(F.col("body")), "xref").otherwise("model")
    return entries.withColumn("source", source).withColumn("gloss", F.when(short, text.collapse_space(translation) if translation is not None else F.lit("")).otherwise(""))


def overwrite(rows: DataFrame, answer: Column, where: Column, source: str | None = None) -> DataFrame:
    """The answer instead of the gloss where the condition holds and there is an answer; ``source`` is then the new mark."""
    takes = F.coalesce(where & (F.trim(answer) != ""), F.lit(False))
    rows = rows.withColumn("_takes", takes).withColumn("gloss", F.when(F.col("_takes"), answer).otherwise(F.col("gloss")))
    return rows.withColumn("source", F.when(F.col("_takes"), source).otherwise(F.col("source")) if source else F.col("source")).drop("_takes")


def says(answer: Column) -> Column:
    """An answer that is there and doesn't decline."""
    return F.coalesce((F.trim(answer) != "") & ~F.upper(F.trim(answer)).isin(DECLINED), F.lit(False))


def declined() -> Column:
    """The model declined or gave nothing, though the article is no pointer."""
    return (F.col("source") == "model") & (F.upper(F.trim("gloss")).isin(*DECLINED, ""))


def first_answers(rows: DataFrame, main: Column, repair: Column, shorten: Column | None = None, name: Column | None = None, cap: Column | None = None) -> DataFrame:
    """Main answers; declined ones asked again; glosses over the cap shortened; glosses that repeat the headword asked again."""
    rows = overwrite(rows, main, F.col("source") == "model")
    rows = overwrite(rows, repair, declined(), "repaired")
    by_model = F.col("source").isin("model", "repaired")
    if shorten is not None:
        long = F.size(words(F.col("gloss"))) > (cap if cap is not None else names.name_cap(F.col("headword")))
        rows = overwrite(rows, shorten, by_model & long & shorten_accepted(F.col("gloss"), shorten))
    if name is not None:
        echo = quality.bare_echo(F.col("headword"), F.col("gloss"))
        rows = overwrite(rows, name, by_model & echo & says(name) & ~quality.bare_echo(F.col("headword"), name), "named")
    return rows


def own_words(rows: DataFrame, definition: Column) -> DataFrame:
    """Names take the article's own definition, whatever was answered; pointers wait for their target."""
    return overwrite(rows, definition, (F.col("source") != "xref") & names.is_name(F.col("headword")), OWN)


def reglossed(rows: DataFrame, answer: Column, uses: Column, mark: str, stems: Column | None = None) -> DataFrame:
    """Glosses the detectors object to take a second answer if they object to nothing in it; the article's own words are not asked again."""
    suspect = F.size(quality.reasons(F.col("headword"), F.col("gloss"), F.col("source"), F.col("body"), uses, stems)) > 0
    clear = F.size(quality.reasons(F.col("headword"), answer, F.lit("model"), F.col("body"), uses, stems)) == 0
    return overwrite(rows, answer, (F.col("source") != OWN) & suspect & says(answer) & clear, mark)


def inherited(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Pointers and declined rows take over the gloss of ``targets (src, dst)`` as it was before this stage, or have none."""
    glosses = rows.select(F.col("idx").alias("dst"), F.col("gloss").alias("_theirs"))
    hit = targets.join(glosses, "dst").select(F.col("src").alias("idx"), "_theirs")
    asks = (F.col("source") == "xref") | F.upper(F.trim("gloss")).isin(DECLINED)
    found = F.coalesce(F.trim("_theirs") != "", F.lit(False))
    rows = rows.join(hit, "idx", "left").withColumn("_asks", asks)
    gloss = F.when(~F.col("_asks"), F.col("gloss")).when(found, F.col("_theirs")).otherwise("")
    source = F.when(~F.col("_asks"), F.col("source")).when(found, "xref-resolved").otherwise("no-gloss")
    return rows.withColumn("source", source).withColumn("gloss", gloss).drop("_theirs", "_asks")


def adapted(rows: DataFrame, answer: Column) -> DataFrame:
    """Adverbs that took over a gloss take its adaptation, unless that is coined, annotated, declined or no change.

    The article's own mark says what is an adverb; where it has none, the headword's ending does.
    """
    mark = text.pos_marker(F.col("body"))
    adverb = F.when(mark.isNotNull(), mark == "adv").otherwise(F.regexp_replace("headword", r"\.+$", "").rlike("(?:[^aeiou]ē|iter|ter|im)$"))
    takes = F.col("source").startswith("xref-resolved") & (F.trim("gloss") != "") & adverb
    return overwrite(rows, answer, takes & says(answer) & ~text.bad_adaptation(answer) & (F.trim(answer) != F.trim("gloss")), "xref-adapted")


def grounded(rows: DataFrame, share: Column, least: float = 0.0, drop: bool = False) -> DataFrame:
    """Written glosses that share no more than ``least`` with their article are marked with a question mark, or also emptied."""
    bad = F.col("source").isin(WRITTEN) & (F.trim("gloss") != "") & (share <= least)
    rows = rows.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    if drop:
        rows = rows.withColumn("gloss", F.when(F.col("_bad"), "").otherwise(F.col("gloss")))
    return rows.withColumn("source", F.when(F.col("_bad"), F.concat("source", F.lit("?"))).otherwise(F.col("source"))).drop("_bad")


def finalised(rows: DataFrame, uses: Column | None = None) -> DataFrame:
    """Glosses cleaned and cut to their cap; what was cut gets a ~ once. Done twice it changes nothing more.

    The article's own words are tidied, all others cleaned, freed of peoples the article doesn't state and, where ``uses`` says how
    many other articles use the headword as a word, of the headword echoed first.
    """
    own = F.regexp_replace("source", "[~?]+$", "") == OWN
    rows = rows.withColumn("_cap", names.name_cap(F.col("headword"))).withColumn("_own", own).withColumn("_tidy", names.name_clean(F.col("gloss"), F.col("headword")))
    rows = clean_glosses(rows.withColumn("_clean", F.col("gloss")), "_clean", F.col("_cap"))
    # written between the steps: a condition on the result would else be tried with all steps in one expression
    rows = materialise(rows, "cleaned")
    rows = rows.withColumn("_clean", names.strip_unstated_people(F.col("_clean"), F.col("body"), F.col("source")))
    if uses is not None:
        rows = rows.withColumn("_clean", text.strip_head_echo(F.col("headword"), F.col("_clean"), uses))
    rows = rows.withColumn("_clean", F.when(F.col("_own"), F.col("_tidy")).otherwise(F.col("_clean"))).withColumn("_final", F.col("_clean"))
    rows = materialise(enforce_cap(rows, "_final", F.col("_cap")), "cut")
    source = F.when(F.col("_final") != F.col("_clean"), mark_once(F.col("source"), "~")).otherwise(F.col("source"))
    return rows.withColumn("source", source).withColumn("gloss", F.col("_final")).drop("_cap", "_own", "_tidy", "_clean", "_final")


def carry_over(rows: DataFrame, earlier: DataFrame) -> DataFrame:
    """Repairs of an earlier build, ``(idx, gloss, source)``, are kept where the row is not the dictionary's own."""
    before = earlier.select("idx", F.col("gloss").alias("_g"), F.col("source").alias("_s"))
    rows = rows.join(before, "idx", "left").withColumn("_keep", F.coalesce(carried(F.col("source"), F.col("_g"), F.col("_s"), OWN), F.lit(False)))
    rows = rows.withColumn("gloss", F.when(F.col("_keep"), F.col("_g")).otherwise(F.col("gloss")))
    return rows.withColumn("source", F.when(F.col("_keep"), F.col("_s")).otherwise(F.col("source"))).drop("_g", "_s", "_keep")


def pointer_repair(gloss: Column, answer: Column, target_word: Column, reasons: Column, coined: Column, score: Column, incumbent: Column, least: int = 4) -> Column:
    """What becomes of a proposed repair, the first that holds: none, objected, coined, target word, unchanged, too weak, no better; else kept."""
    empty = F.coalesce(F.trim(gloss), F.lit("")) == ""
    return (
        F.when(~says(answer), "none")
        .when(F.size(reasons) > 0, "objected")
        .when(coined, "coined")
        .when(F.coalesce(letters(answer) == letters(target_word), F.lit(False)), "target word")
        .when(F.coalesce(letters(answer) == letters(gloss), F.lit(False)), "unchanged")
        .when(F.coalesce(score < least, F.lit(True)), "too weak")
        .when(~empty & F.coalesce(score <= incumbent, F.lit(False)), "no better")
        .otherwise("kept")
    )
