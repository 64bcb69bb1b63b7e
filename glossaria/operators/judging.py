"""Decisions about judged glosses: consensus, verification, refinement, acceptance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossaria.functions.normalize import letters


def consensus(a: Column, b: Column) -> Column:
    """Verdict of two judges, the first that holds: unjudged, both-bad, disagree, judgeB-ok, weak."""
    return (
        F.when(b.isNull(), "unjudged")
        .when((a <= 2) & (b <= 2), "both-bad")
        .when(F.abs(a - b) >= 3, "disagree")
        .when(b >= 4, "judgeB-ok")
        .otherwise("weak")
    )


def verify(before: Column, after: Column) -> Column:
    """keep from 4 on; otherwise revert if worse than before, else flag."""
    return F.when(after.isNull(), "todo").when(after >= 4, "keep").when(after < F.coalesce(before, F.lit(-1)), "revert").otherwise("flag")


def mark_once(source: Column, mark: str) -> Column:
    """A source label with a mark at its end, never twice."""
    return F.when(source.endswith(mark), source).otherwise(F.concat(source, F.lit(mark)))


def refine_accepted(old: Column, new: Column) -> Column:
    """Only a strictly better score is taken."""
    return F.coalesce(new > old, F.lit(False))


def worst_valid(*scores: Column) -> Column:
    """The least of several verdicts; negative ones are failed judgements and don't count."""
    return F.array_min(F.filter(F.array(*scores), lambda s: s >= 0))


def better(map_score: Column, incumbent_map: Column, opening: Column, incumbent_opening: Column) -> Column:
    """A candidate replaces the incumbent: at least 4 against the sense map, more than it there, and not less at the opening."""
    return F.coalesce((map_score >= 4) & (map_score > incumbent_map) & (opening >= incumbent_opening), F.lit(False))


def overlap_verdict(ours: Column, gold: Column) -> Column:
    """PASS, REVIEW, FAIL or EMPTY for two word arrays: one contains the other, half in common, less, or nothing said."""
    common, every = F.size(F.array_intersect(ours, gold)), F.size(F.array_union(ours, gold))
    contained = (common == F.size(F.array_distinct(ours))) | (common == F.size(F.array_distinct(gold)))
    return F.when(F.size(ours) == 0, "EMPTY").when(contained & (common > 0), "PASS").when(common / every >= 0.5, "REVIEW").otherwise("FAIL")


def metric_change(kind: Column, old: Column, new: Column, old_share: Column, new_share: Column) -> Column:
    """Of a metric: counts are worse only if number and share (to 4 places) both rise, coverage if it falls; 'info' never."""
    up, share_up = new > old, F.round(new_share, 4) > F.round(old_share, 4)
    return (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "removed")
        .when(kind == "info", "info")
        .when(kind == "coverage", F.when(new < old, "worse").when(new > old, "better").otherwise("same"))
        .otherwise(F.when(up & share_up, "worse").when(new < old, "better").when(up, "scale").otherwise("same"))
    )


# Detectors whose objection means that a gloss says nothing of its word.
NO_GLOSS = ["bare-echo", "word-class", "form-note", "editorial-apparatus", "fragment", "etymology-leak"]


def ship_reason(source: Column, gloss: Column, lemma: Column, reasons: Column, own: Column | None = None, target: Column | None = None, target_is_function: Column | None = None) -> Column:
    """Why a row is not shipped, the first that holds, or 'shipped'.

    no gloss; unresolved (!); ungrounded (? or the detector); detector; adverb: a pointer marked as an adverb took over what is none,
    where ``own`` and ``target`` are the two marks; echo of the lemma.
    """
    if own is None or target is None:
        adverb = F.lit(False)
    else:
        function = F.coalesce(target_is_function, F.lit(False)) if target_is_function is not None else F.lit(False)
        adverb = F.coalesce(source.startswith("xref") & (own == "adv") & ~function, F.lit(False)) & ~F.coalesce(target == "adv", F.lit(False))
    return (
        F.when(F.coalesce(F.trim(gloss), F.lit("")) == "", "no gloss")
        .when(source.endswith("!"), "unresolved")
        .when(source.contains("?") | F.array_contains(reasons, "ungrounded"), "ungrounded")
        .when(F.arrays_overlap(reasons, F.array(*map(F.lit, NO_GLOSS))), "detector")
        .when(adverb, "adverb")
        .when(letters(gloss) == letters(lemma), "echo")
        .otherwise("shipped")
    )


def scores_pass(score: Column, least: int) -> Column:
    """Rows whose judge's score is below ``least`` are left out; those without a score pass."""
    return F.coalesce(score >= least, F.lit(True))


def repair_reason(gloss: Column, reasons: Column, score: Column, least: int) -> Column:
    """What a row is to be repaired for, the first that holds, or null: it is empty, a detector objects, a judge gave at most ``least`` (failed judgements don't count)."""
    return F.when(F.coalesce(F.trim(gloss), F.lit("")) == "", "empty").when(F.size(reasons) > 0, F.element_at(reasons, 1)).when(score.between(0, least), "judge")


def shorten_accepted(old: Column, new: Column) -> Column:
    """A shortened gloss is taken if it says something in no more words than before."""
    return F.coalesce((F.trim(new) != "") & (F.size(F.split(F.trim(new), r"\s+")) <= F.size(F.split(F.trim(old), r"\s+"))), F.lit(False))


def carried(source: Column, earlier_gloss: Column, earlier_source: Column, own: str = "ls") -> Column:
    """An earlier repair is kept where it has a gloss and the row's own gloss is not the dictionary's."""
    repaired = F.regexp_replace(earlier_source, "[~?!]+$", "").isin("xrefix", "refilled", "freqfix")
    return F.coalesce(repaired & (F.trim(earlier_gloss) != ""), F.lit(False)) & F.coalesce(F.regexp_replace(source, "~+$", "") != own, F.lit(True))
