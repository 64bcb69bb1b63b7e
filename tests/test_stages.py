from __future__ import annotations

from pyspark.sql import functions as F

from glossaria.operators import stages as S

ROW = "idx int, headword string, body string, gloss string, source string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


def told(df):
    return {r["idx"]: (r["gloss"], r["source"]) for r in df.collect()}


def test_last_answer_of_each_pass(spark):
    log = spark.createDataFrame([(1, "main", "a", 1), (1, "main", "b", 2), (1, "main", " ", 3), (1, "retry", "c", 1), (2, "name", None, 1)], "idx int, p string, answer string, at int")
    assert [tuple(r) for r in S.answers_by_pass(log, ["main", "retry"]).collect()] == [(1, "b", "c")]


def test_classify(spark):
    df = spark.createDataFrame([(1, "a", "abditus, v. abdo", "hidden"), (2, "b", "rosa, a flower", " rose "), (3, "c", "x, a thing", "one two three four five six")], "idx int, headword string, body string, tr string")
    assert told(S.classify(df)) == {1: ("", "xref"), 2: ("", "model"), 3: ("", "model")}
    assert told(S.classify(df, F.col("tr"))) == {1: ("hidden", "tr"), 2: ("rose", "tr"), 3: ("", "model")}


def test_first_answers(spark):
    df = rows(spark, (1, "rosa", "b", "", "model"), (2, "rosa", "b", "", "model"), (3, "rosa", "b", "", "xref"), (4, "Melos", "b", "", "model"), (5, "rosa", "b", "", "model"), (6, "rosa", "b", "", "model"))
    a = spark.createDataFrame(
        [(1, "rose", "x", None, None), (2, "NONE", "flower", None, None), (3, "xref", "x", None, None), (4, "Melos, i", None, None, "an island"), (5, "one two three four five six seven", None, "one two three", None), (6, "one two three four five six", None, "one two three four five six seven", "x")],
        "idx int, main string, retry string, short string, name string",
    )
    got = told(S.first_answers(df.join(a, "idx"), F.col("main"), F.col("retry"), F.col("short"), F.col("name")))
    assert got == {1: ("rose", "model"), 2: ("flower", "repaired"), 3: ("", "xref"), 4: ("an island", "named"), 5: ("one two three", "model"), 6: ("one two three four five six", "model")}


def test_own_words_of_names_only(spark):
    df = rows(spark, (1, "Melos", "b", "x", "model"), (2, "rosa", "b", "x", "model"), (3, "Melos", "b", "", "xref")).withColumn("d", F.lit("an island"))
    assert told(S.own_words(df, F.col("d"))) == {1: ("an island", "ls"), 2: ("x", "model"), 3: ("", "xref")}


def test_suspects_take_only_what_is_clear(spark):
    df = rows(spark, (1, "rosa", "rosa, f. a flower", "rosa", "model"), (2, "rosa", "rosa, f. a flower", "rosa", "model"), (3, "rosa", "rosa, f. a flower", "rosa", "ls"), (4, "rosa", "rosa, f. a flower", "flower", "model"))
    df = df.withColumn("a", F.when(F.col("idx") == 2, "of the").otherwise("a flower"))
    assert told(S.reglossed(df, F.col("a"), F.lit(0), "hard")) == {1: ("a flower", "hard"), 2: ("rosa", "model"), 3: ("rosa", "ls"), 4: ("flower", "model")}


def test_pointers_inherit_what_stood_before_the_stage(spark):
    df = rows(spark, (1, "a", "b", "", "xref"), (2, "b", "b", "to love", "model"), (3, "c", "b", "none", "model"), (4, "d", "b", "", "xref"), (5, "e", "b", "", "xref"))
    targets = spark.createDataFrame([(1, 2), (3, 2), (5, 1)], "src int, dst int")
    assert told(S.inherited(df, targets)) == {1: ("to love", "xref-resolved"), 2: ("to love", "model"), 3: ("to love", "xref-resolved"), 4: ("", "no-gloss"), 5: ("", "no-gloss")}


def test_adverbs_are_adapted(spark):
    df = rows(
        spark,
        (1, "impurē", "impurē, adv., v. impurus", "unclean", "xref-resolved"),
        (2, "pater", "pater, m.", "father", "xref-resolved"),
        (3, "celeriter", "v. celer", "swift", "xref-resolved"),
        (4, "celeriter", "v. celer", "swift", "model"),
    ).withColumn("a", F.when(F.col("idx") == 3, "swiftlyly").otherwise("uncleanly"))
    assert told(S.adapted(df, F.col("a"))) == {1: ("uncleanly", "xref-adapted"), 2: ("uncleanly", "xref-adapted"), 3: ("swift", "xref-resolved"), 4: ("swift", "model")}


def test_grounding_marks_or_empties(spark):
    df = rows(spark, (1, "a", "b", "x", "model"), (2, "a", "b", "x", "tr"), (3, "a", "b", "", "model"), (4, "a", "b", "y", "hard"))
    share = F.when(F.col("gloss") == "y", 0.5).otherwise(0.0)
    assert told(S.grounded(df, share)) == {1: ("x", "model?"), 2: ("x", "tr"), 3: ("", "model"), 4: ("y", "hard")}
    assert told(S.grounded(df, share, drop=True))[1] == ("", "model?")


def test_finalise_twice_changes_nothing_more(spark):
    df = rows(
        spark,
        (1, "rosa", "a flower", "the wild rose of the wide land beyond", "model"),
        (2, "Melos", "an island", "an island in the Aegean sea, now Milo, famous for many things of old", "ls"),
        (3, "tamen", "b", "tamen, nevertheless", "model~"),
        (4, "faber", "a sculptor", "Athenian sculptor", "model"),
        (5, "faber", "a sculptor", "Athenian sculptor", "xref-resolved"),
        (6, "x", "b", "", "no-gloss"),
    )
    once = S.finalised(df, F.lit(0))
    got = told(once)
    assert got[3] == ("nevertheless", "model~") and got[4] == ("sculptor", "model") and got[5] == ("Athenian sculptor", "xref-resolved") and got[6] == ("", "no-gloss")
    assert got[1][1] == "model~" and len(got[1][0].split()) <= 5 and len(got[2][0].split()) <= 10
    assert told(S.finalised(once, F.lit(0))) == got


def test_carry_over(spark):
    df = rows(spark, (1, "a", "b", "new", "model~"), (2, "a", "b", "own", "ls~"), (3, "a", "b", "new", "model"), (4, "a", "b", "new", "model"))
    earlier = spark.createDataFrame([(1, "kept", "freqfix!"), (2, "kept", "xrefix"), (3, "kept", "model"), (4, " ", "refilled")], "idx int, gloss string, source string")
    assert told(S.carry_over(df, earlier)) == {1: ("kept", "freqfix!"), 2: ("own", "ls~"), 3: ("new", "model"), 4: ("new", "model")}


def test_pointer_repair(spark):
    cases = [("", "NONE", 5, "none"), ("", "boil", 5, "target word"), ("hot", "Hot", 5, "unchanged"), ("hot", "warm", 3, "too weak"), ("hot", "warm", 4, "no better"), ("", "warm", 4, "kept"), ("hot", "warm", 5, "kept"), ("hot", "coin", 5, "coined"), ("hot", "of", 5, "objected")]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, gloss string, answer string, score int, want string")
    reasons = F.when(F.col("answer") == "of", F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    got = S.pointer_repair(F.col("gloss"), F.col("answer"), F.lit("Boil"), reasons, F.col("answer") == "coin", F.col("score"), F.lit(4))
    assert [(r["want"], r["got"]) for r in df.select("want", got.alias("got")).collect()] == [(c[-1], c[-1]) for c in cases]
