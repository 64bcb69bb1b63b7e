from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.functions import quality as Q
from glossaria.functions import readings as R
from glossaria.functions import text as T


@pytest.mark.parametrize(
    ("text", "fold", "letters", "plain"),
    [
        ("Jūvō", "iuuo", "juvo", "juvo"),
        ("quæso", "quaeso", "quaeso", "quaeso"),
        ("prō-cŏnsul", "proconsul", "proconsul", "pro-consul"),
        ("Bacchўlĭdēs", "bacchylides", "bacchylides", "bacchylides"),
        ("ō̆re", "ore", "ore", "ore"),
        ("", "", "", ""),
        ("12 §", "", "", ""),
    ],
)
def test_keys(one, text, fold, letters, plain):
    assert [one(f(F.col("t")), t=text) for f in (N.fold, N.letters, N.plain)] == [fold, letters, plain]


def test_accent_table_agrees_with_unicode():
    for char, base in zip(*N.accent_table(), strict=True):
        assert "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower() == base


def test_null_stays_null(spark):
    row = spark.sql("select cast(null as string) t").select(N.fold(F.col("t")), N.plain(F.col("t")), T.focus(F.col("t")), T.parse_score(F.col("t"))).first()
    assert list(row) == [None] * 4


@pytest.mark.parametrize(("text", "want"), [("<a x='1'>b  c</a>\n d", "b c d"), ("", ""), ("a b", "a b")])
def test_strip_tags(one, text, want):
    assert one(T.strip_tags(F.col("t")), t=text) == want


def test_focus_peels_nested_brackets(one):
    assert one(T.focus(F.col("t")), t="ago, (a (b) [c]) to drive") == "ago: ago, to drive"


@pytest.mark.parametrize(
    ("reply", "score"),
    [("4 - good", 4), ('"3"', 3), ("Score: 5", 5), ("the grade is (2)", 2), ("it has 3 words, rated 4", None), ("I say 1", 1), ("2.5", None), ("7", None), ("", None), ("10", None), ("The gloss has 3 words; score of 1", 1)],
)
def test_parse_score(one, reply, score):
    assert one(T.parse_score(F.col("t")), t=reply) == score


@pytest.mark.parametrize(("text", "word", "number"), [("v. condicio", "condicio", None), ("see v. 2. repens", "repens", 2), ("amo, v. a. to love", None, None), ("abditus, Part. of abdo.", "abdo", None), ("(v. alius) nothing", None, None), ("cf. Fronto Ter. Als. 4", None, None), ("Adv. comp.", None, None)])
def test_reference_target(one, text, word, number):
    n, w = T.reference_target(F.col("t"))
    assert (one(w, t=text), one(n, t=text)) == (word, number)


@pytest.mark.parametrize(("form", "host", "name"), [("uirumque", "uirum", "que"), ("namque", "namque", ""), ("uirumue", "uirum", "ve"), ("siue", "siue", ""), ("que", "que", ""), ("", "", "")])
def test_split_enclitic(one, form, host, name):
    h, e = T.split_enclitic(F.col("t"))
    assert (one(h, t=form), one(e, t=form)) == (host, name)


@pytest.mark.parametrize(("text", "want"), [("a b a b c", "a b"), ("to go go away", "to go"), ("no loop here", "no loop here"), ("", ""), ("x", "x")])
def test_collapse(one, text, want):
    assert one(T.collapse_repeats(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("love, affection; strong desire for honour", "love, affection"), ("one", "one"), ("a very long first part of it, more", "a very long first part of it"), (", ;", ", ;")])
def test_pack(one, text, want):
    assert one(T.pack_parts(F.col("t")), t=text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("the wild wolf.", "wild wolf"), ("love (verb)", "love"), ("to drive, Plin. 3, 4", "to drive"), ("one of 12 lictors", "one of 12 lictors"), ("box (note: user asked)", "box"), ("", ""), ("and", "and"), ("Roman cognomen", "Roman surname"), ("out of", "out of")],
)
def test_clean_and_again(spark, text, want):
    df = spark.createDataFrame([(text,)], "g string")
    once = T.clean_glosses(df, "g")
    assert once.first()[0] == want
    assert T.clean_glosses(once, "g").first()[0] == want


@pytest.mark.parametrize("text", ["city on the borders of the wide land", "of or belonging to a deity of the house", "one who is of the household of", "a b c d e f g h", "short one", "", "of or suited to an assembly of the people"])
def test_enforce_keeps_the_cap(spark, text):
    out = T.enforce_cap(spark.createDataFrame([(text,)], "g string"), "g").first()[0]
    assert len(out.split()) <= 5
    assert (out == "") == (text == "")
    if len(text.split()) > 5:
        assert out.split()[-1] not in ("of", "the", "to", "on", "a")


@pytest.mark.parametrize(
    ("head", "gloss", "body", "want"),
    [
        ("abathon", "false reading in Vitruvius", "abathon, false reading", ["editorial-apparatus"]),
        ("melos", "melos, i", "melos, i, n.", ["bare-echo", "head-echo"]),
        ("agito", "old form of ago", "agito", ["form-note"]),
        ("et", "conjunction", "et, conj.", ["word-class"]),
        ("x", "one who is", "x, adj. rough", ["fragment"]),
        ("x", "of or made", "x, adj. rough", ["fragment"]),
        ("ego", "I, myself", "ego, pron. pers.", []),
        ("x", "rōsa flower", "x flower", ["latin-chars"]),
        ("x", "", "x", []),
        ("sos", "he, she, it", "sos, a form", []),
    ],
)
def test_reasons(one, head, gloss, body, want):
    cols = [F.col(c) for c in ("h", "g", "s", "b", "u")]
    assert one(Q.reasons(*cols), h=head, g=gloss, s="tr", b=body, u=0) == want


def test_head_echo_needs_an_unused_word(one):
    cols = [F.col(c) for c in ("h", "g", "s", "b", "u")]
    assert one(Q.reasons(*cols), h="tamen", g="tamen, nevertheless", s="tr", b="tamen, nevertheless", u=0) == ["head-echo"]
    assert one(Q.reasons(*cols), h="orator", g="orator, speaker", s="tr", b="orator, speaker", u=3) == []
    assert one(T.strip_head_echo(F.col("h"), F.col("g"), F.col("u")), h="tamen", g="tamen, nevertheless, still", u=0) == "nevertheless, still"


@pytest.mark.parametrize(("gloss", "body", "want"), [("wild wolf", "a wolf of the wild", 1.0), ("wolf bird", "wolves", 0.0), ("wolf bird", "a wolf", 0.5), ("of the", "x", 1.0), ("wolf wolf bird", "wolf", 2 / 3)])
def test_grounding(one, gloss, body, want):
    assert one(Q.grounding(F.col("g"), Q.known_stems(F.col("b"))), g=gloss, b=body) == pytest.approx(want)


@pytest.mark.parametrize(("tag", "want"), [("v3spip---", "3 s pres passive ind"), ("v--pna---", "0 pres active inf"), ("n-s---fn-", "nom s f"), ("c--------", "conj"), ("", ""), ("n", ""), ("v3zpia---", "3 pres active ind")])
def test_tag_reading(one, tag, want):
    assert one(R.tag_reading(F.col("t")), t=tag) == want


def test_render_rejects_foreign_values(spark):
    with pytest.raises(Exception, match="not a case"):
        spark.range(1).select(R.render({"case": F.lit("ergative")})).collect()


def test_merge_drops_covered_readings(spark):
    df = spark.createDataFrame([(["n", "acc p n", "nom p n", "acc p n", None, ""],), ([],)], "r array<string>")
    assert [r[0] for r in df.select(R.merge_readings(F.col("r"))).collect()] == ["acc p n|nom p n", ""]


@pytest.mark.parametrize(("cell", "gold", "want"), [(None, "nom s f", "absent"), ("", "nom s f", "blank"), ("nom s f|voc s f", "nom s f", "exact"), ("nom s", "nom s f", "compatible"), ("nom s c", "nom s f", "compatible"), ("acc s f", "nom s f", "contradicted"), ("adv", "nom s f", "contradicted")])
def test_cell_state(spark, cell, gold, want):
    df = spark.createDataFrame([(cell, gold)], "c string, g string")
    assert df.select(R.cell_state(F.col("c"), F.col("g"))).first()[0] == want


def test_windows_and_best(spark):
    df = spark.createDataFrame([("x" * 2000,), ("short",), (None,)], "t string")
    found = [r[0] for r in df.select(T.windows(F.col("t"))).collect()]
    assert [(w["at"], len(w["part"])) for w in found[0]] == [(0, 800), (1600, 400)]
    assert found[1] == [] and not found[2]
    s = spark.sql("select array(named_struct('at', 0, 'score', 3), named_struct('at', 1600, 'score', 5), named_struct('at', 3200, 'score', 5)) a, array(named_struct('at', 0, 'score', 2), named_struct('at', 9, 'score', 2)) b")
    assert list(s.select(T.best_window(F.col("a")), T.best_window(F.col("b"))).first()) == [1600, 0]
