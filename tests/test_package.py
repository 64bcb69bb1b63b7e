from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glossaria.functions import quality as Q
from glossaria.functions import text as T
from glossaria.operators import package as K

SENSES = "lemma string, idx int, gloss string, pointer boolean, size int, score int, seen int, bad boolean, is_function boolean"


def senses(spark, *rows):
    return spark.createDataFrame(list(rows), SENSES)


def test_long_articles_lead_and_pointers_come_last(spark):
    df = senses(spark, ("litus", 1, "smeared", True, 900, 5, 0, False, False), ("litus", 2, "smearing", False, 50, 5, 0, False, False), ("litus", 3, "shore", False, 400, None, 0, False, False))
    assert {(r["idx"], r["n"]) for r in K.primary_senses(df).collect()} == {(3, 1), (2, 2), (1, 3)}
    assert K.primary_senses(df.where("false")).count() == 0


def test_an_excluded_primary_takes_its_lemma_unless_it_is_a_function_word(spark):
    df = senses(
        spark,
        ("pietas", 1, "pius", False, 900, 5, 0, True, False), ("pietas", 2, "surname", False, 50, 5, 0, False, False),  # the lemma goes
        ("sero", 1, "late", False, 900, 5, 1, True, True), ("sero", 2, "to sow", False, 50, 5, 7, False, False),  # the verb takes over
        ("magis", 1, "great", False, 900, 5, 53, True, True), ("magis", 2, "dish", False, 50, 5, 2, False, False),  # readers meet the function word
        ("x", 1, "a", False, 900, 5, 0, True, True), ("x", 2, "b", False, 800, 5, 0, True, True), ("x", 3, "c", False, 700, 5, 0, False, False),  # two give way
        ("y", 1, "a", False, 900, 5, 0, True, True),  # nothing to give way to
    )
    assert {(r["lemma"], r["idx"], r["n"]) for r in K.primary_senses(df).collect()} == {("sero", 2, 1), ("x", 3, 1)}


def test_decisive_counts_come_before_length(spark):
    df = senses(spark, ("gallus", 1, "river", False, 900, 5, 0, False, False), ("gallus", 2, "a Gaul", False, 50, 5, 9, False, False))
    assert K.primary_senses(df, F.lit(True)).where("n = 1").first()["idx"] == 2


def test_majority_leads_namesakes_follow_and_strangers_go(spark):
    cands = spark.createDataFrame([("f", "alius", "alius", 0.5), ("f", "alius2", "alius", 0.95), ("f", "elis", "elis", 0.95), ("g", "suo", "suo", 0.8), ("g", "mecum", "mecum", 0.7), ("h", "res", "res", 0.6)], "form string, lemma string, bare string, conf double")
    votes = spark.createDataFrame([("f", "alius", 9), ("f", "elis", 1), ("g", "ego", 7), ("h", "res", 2)], "form string, bare string, n int")
    targets = spark.createDataFrame([("mecum", "ego"), ("mecum", "ego")], "bare string, target string")
    got = {(r["form"], r["lemma"]): r["conf"] for r in K.lead_by_majority(cands, votes, targets).collect()}
    assert got == {("f", "alius"): 1.0, ("f", "alius2"): 0.99, ("f", "elis"): 0.89, ("g", "mecum"): 0.7, ("h", "res"): 0.6}


def test_joined_forms_need_their_host(spark):
    rows = [("uirum", f"l{k}", 0.9 - k / 10, k, None, False) for k in range(4)] + [("uirumque", "l0", 0.6, 0, "uirum", False), ("uirumque", "l3", 0.2, 3, "uirum", False), ("uirumque", None, 0.3, 0, None, False)]
    rows += [("tinuoque", None, 0.3, 0, None, False), ("denique", None, 0.3, 0, None, True)]
    df = spark.createDataFrame(rows, "form string, lemma string, conf double, ord int, host string, is_head boolean")
    got = {(r["form"], r["lemma"]) for r in K.drop_orphaned(df).collect()}
    assert got == {("uirum", f"l{k}") for k in range(4)} | {("uirumque", "l0"), ("uirumque", None), ("denique", None)}


def test_gold_outcomes_and_slots(spark):
    gold = spark.createDataFrame([("a", "x", "nom s f", 2), ("b", "x", "nom s f", 3), ("c", "x", "gen s f", 1), ("d", "y", "3 s pres active ind", 1), ("e", "x", "nom p f", 5), ("f", "z", "abl s", 1)], "form string, lemma string, reading string, n int")
    pack = spark.createDataFrame([("a", "x", "nom s f|abl s f"), ("b", "other", "nom s f"), ("c", "x", ""), ("d", "y", "1 s pres ind"), ("e", "x", "nom f")], "form string, lemma string, cell string")
    judged = K.against_gold(gold, pack)
    assert {r["form"]: r["outcome"] for r in judged.collect()} == {"a": "exact", "b": "lemma not offered", "c": "no reading offered", "d": "contradicted", "e": "compatible", "f": "form not indexed"}
    assert {(r["slot"], r["ours"], r["gold"], r["n"]) for r in K.slot_disagreements(judged).collect()} == {("person", "1", "3", 1), ("voice", None, "active", 1)}


def test_zip_by_position_loses_no_row(spark):
    a, b = spark.createDataFrame([(0, "a"), (1, "b")], "idx int, l string"), spark.createDataFrame([(1, "y"), (0, "x")], "idx int, r string")
    assert {tuple(r) for r in K.positional_zip(a, b).collect()} == {(0, "a", "x"), (1, "b", "y")}
    with pytest.raises(Exception, match="no counterpart at 1"):
        K.positional_zip(a, b.where("idx = 0")).collect()


@pytest.mark.parametrize(("text", "want"), [("wellly done", True), ("to beforebear", True), ("to love (verb)", True), ("overcome", True), ("sweetly", False), ("", False)])
def test_bad_adaptations(one, text, want):
    assert one(T.bad_adaptation(F.col("t")), t=text) is want


def test_headline_forms_stop_at_the_part_of_speech(one):
    assert one(T.headline_forms(F.col("t")), t="ĕgo (gen. mei, dat. mihi), pers. pron. I, me") == ["ego", "mei", "mihi"]
    assert one(T.headline_forms(F.col("t")), t="") == []


def test_template(one):
    assert one(T.fill_template(F.col("t"), HEAD=F.lit("rosa"), ENTRY=F.lit("{HEAD}")), t="{HEAD}: {ENTRY} {HEAD}") == "rosa: {HEAD} rosa"


@pytest.mark.parametrize(
    ("gloss", "source", "body", "want"),
    [
        ("an ancient city", "model~", "x, f. a plant", ["ungrounded"]),
        ("an ancient city", "model?", "x, f. a plant", ["ungrounded"]),
        ("an ancient city", "tr", "x, f. a plant", []),
        ("first letter of the Latin alphabet", "tr", "a", ["word-class"]),
        ("denoting separation", "tr", "ab, praep. with abl. from", ["word-class"]),
        ("denoting separation", "tr", "rosa, f. a plant", []),
        ("to the", "xref-resolved~", "x, f. a plant", ["fragment"]),
        ("not", "xref-resolved", "x, f. a plant", []),
        ("not", "tr", "x, f. a plant", ["fragment"]),
        ("canus", "tr", "x, 3 canus, a plant", ["etymology-leak"]),
        ("to flee", "xref-resolved~?", "x, a plant", ["adv-inherits-verb"]),
    ],
)
def test_detectors_in_full(one, gloss, source, body, want):
    head = "celeriter" if "adv-inherits-verb" in want else "xyz"
    assert one(Q.reasons(*[F.col(c) for c in "hgsbu"]), h=head, g=gloss, s=source, b=body, u=0) == want
