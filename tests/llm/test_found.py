from __future__ import annotations

import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossaria.llm import mixing, packing, pairs, tokens, topn, truncation
from glossaria.llm.confusables import LOOK_ALIKE, consistent, consistent_form
from glossaria.llm.pii import Finder, NameBook, find_pii, redact, replace

# --- truncated texts -------------------------------------------------------------------------------------

NOUNS = "merchant shepherd garden harness evening morning valley river pilgrim sparrow anchor candle orchard vessel trumpet stranger".split()
VERBS = "carries lifts repairs summons shelters scatters plunders imitates".split()


def glosses():
    rows = []
    for k, (v, n) in enumerate((v, n) for v in VERBS for n in NOUNS):
        rows += [(f"k{k}", f"one who {v} the {n}"), (f"m{k}", f"the {n} of a {NOUNS[(k * 7) % 16]}"), (f"n{k}", f"one who {v} the {n}; the {NOUNS[(k * 5) % 16]} of an {NOUNS[(k * 3) % 16]}")]
    return rows + [(f"w{k}", "what kind of") for k in range(30)]


CUT = ["one who lifts the", "the garden of a", "one who carries the merc", "the valley of a shephe", "one who repairs the trum…", "one who plunders the stran...", "the river of an eveni�"]
WHOLE = ["what kind of", "one who lifts the river", "the garden of a zephyr", "one who summons the garden.", "", "   ", None, "one who imitates the anchor "]


def test_cut_texts_are_found_and_whole_ones_are_not(spark):
    rows = [("t", i, "s", o, t) for i, (o, t) in enumerate(glosses() + [("x", t) for t in CUT + WHOLE])]
    df = spark.createDataFrame(rows + [rows[-12]], "tab string, row_id bigint, source string, owner string, text string")
    found = {t for (t,) in df.join(truncation.find_truncated(df).select("row_id"), "row_id", "left_semi").select("text").collect()}
    assert found == set(CUT)


def test_truncation_of_nothing(spark):
    schema = "tab string, row_id bigint, source string, owner string, text string"
    assert truncation.find_truncated(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("t", 1, None, None, "x" * 200_000), ("t", 2, None, None, None)], schema)
    assert [tuple(r) for r in truncation.truncation_rates(df).collect()] == [("t", None, 1, 0, 0.0)]


def test_a_hot_text_is_judged_once_and_found_in_every_row(spark, monkeypatch):
    from glossaria.operators import skew

    rows = [("t", i, "s", o, t) for i, (o, t) in enumerate(glosses() + [("x", "one who lifts the")] * 40 + [("y", "what kind of")] * 40)]
    df = spark.createDataFrame(rows, "tab string, row_id bigint, source string, owner string, text string")
    hot = truncation.hot_hashes(df.select("text", F.lit(1).alias("n")), ["text"], least_rows=20)
    assert len(hot) == 2
    monkeypatch.setattr(truncation, "hot_hashes", lambda *a, **k: hot)
    assert truncation.find_truncated(df).count() == 40
    assert skew.spread_join(df, df.select("text").distinct(), ["text"], "left_anti", hot).count() == 0


def test_long_words_have_their_beginnings_counted(spark):
    word = "pneumono" * 20
    rows = [("t", i, "s", f"k{i}", f"one who {v} the {word}, {NOUNS[i % 16]}") for i, v in enumerate(VERBS * 10)] + [("t", 500 + i, "s", o, t) for i, (o, t) in enumerate(glosses())]
    rows += [("t", 1000, "s", "x", f"one who lifts the {word[:100]}"), ("t", 1001, "s", "y", f"one who lifts the {word}")]
    df = spark.createDataFrame(rows, "tab string, row_id bigint, source string, owner string, text string")
    assert [r["row_id"] for r in truncation.find_truncated(df).collect()] == [1000]


# --- look-alike characters -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "want"),
    [("ｒｏｓａ", "rosa"), ("rоsa", "rosa"), ("ϲaesar", "caesar"), ("r​o­sa﻿", "rosa"), (" a  b　", "a b"), ("ﬂos", "flos"), ("ā", "ā"), ("ō̆", "ō̆"), ("in‐spiro", "in-spiro"), ("λόγος", "λόγος"), ("λόγος​", "λόγος"), ("Iulius 2", "Iulius 2"), ("​", ""), ("", ""), ("е̄", "ē")],
)
def test_consistent_form(text, want):
    assert consistent_form(text) == want


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_consistent_form_is_stable(text):
    once = consistent_form(text)
    assert consistent_form(once) == once
    assert not any(unicodedata.category(c) == "Cf" and ord(c) in (0x200B, 0x200D, 0xFEFF, 0xAD) for c in once)


def test_column_equals_function(spark):
    values = ["rosa", "rōsa", "ō̆", "a  b", " a", "a ", "ŏ", "rоsa", None, "", "x" * 5000, "λόγος", "A-b", "ａ" * 3000] * 2
    df = spark.createDataFrame([(i, v, "clash") for i, v in enumerate(values)], "id int, v string, value string")
    got = {r["id"]: r["c"] for r in df.select("id", consistent(F.col("v")).alias("c")).collect()}
    assert got == {i: consistent_form(v) for i, v in enumerate(values)}
    assert df.select(consistent(F.lit("ROSA"), fold_case=True)).first()[0] == "rosa"


def test_column_equals_function_at_line_breaks(spark):
    values = [f"{word}{end}" for word in ("", "rosa", "rosa alba", "rosa\n") for end in ("\n", "\r\n", "\r", "\u0085", "\u2028", "\u2029")]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    for fold_case in (False, True):
        got = {r["id"]: r["c"] for r in df.select("id", consistent(F.col("v"), fold_case).alias("c")).collect()}
        assert got == {i: consistent_form(v, fold_case) for i, v in enumerate(values)}
    assert consistent_form("rosa\r\n") == "rosa" and consistent_form("\n") == ""


def test_every_look_alike_maps_to_latin():
    for latin, others in LOOK_ALIKE.items():
        assert {consistent_form(f"x{c}x") for c in others} == {f"x{latin}x"}


# --- top N -----------------------------------------------------------------------------------------------


def brute_top(rows, n=3):
    best = {}
    for g, item, score, row_id in rows:
        if g is None or item is None or score is None:
            continue
        if (g, item) not in best or (score, -row_id) > (best[g, item][0], -best[g, item][1]):
            best[g, item] = (score, row_id)
    groups = defaultdict(list)
    for (g, item), (score, row_id) in best.items():
        groups[g].append((-score, item.encode(), row_id))
    return {r for items in groups.values() for *_, r in sorted(items)[:n]}


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_top_n_equals_brute_force(spark, hot):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < hot else f"g{rng.randrange(40)}", f"i{rng.randrange(60)}é", rng.randrange(6), k) for k in range(20_000)]
    rows += [(None, "a", 1, 90_001), ("g1", None, 1, 90_002), ("g1", "a", None, 90_003), ("", "x", 5, 90_004), ("solo", "x", -3, 90_005)]
    df = spark.createDataFrame(rows, "lemma string, form string, freq bigint, row_id bigint")
    got = topn.top_n(df, "lemma", "form", "freq", "row_id", rows_per_group=100)
    ids = [r["row_id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == brute_top(rows)


def test_top_n_skips_what_cannot_matter(spark):
    df = spark.range(60_000).selectExpr("'hot' as g", "concat('i', id) as item", "60000 - id as score", "id as row_id")
    path = topn.cluster_by_group(df, rows_per_group=2_000, partitions=4)
    stats = topn.footers(spark, path)
    assert stats.count() > 8
    n = topn.row_groups_read(spark, path, 3).first()
    assert n["row_groups"] == stats.count() and n["read"] <= 5 and n["rows"] == 60_000
    assert sorted(r["row_id"] for r in topn.top_n_from_clustered(spark, path, 3).collect()) == [0, 1, 2]


def test_top_n_on_a_file_system_without_a_reader(spark, monkeypatch):
    df = spark.range(500).selectExpr("cast(id % 7 as string) as g", "concat('i', id) as item", "id % 50 as score", "id as row_id")

    def none(path):
        raise ValueError(path)

    want = sorted(r["row_id"] for r in topn.top_n(df, "g", "item", "score", "row_id").collect())
    monkeypatch.setattr(topn, "_file_system", none)
    assert sorted(r["row_id"] for r in topn.top_n(df, "g", "item", "score", "row_id").collect()) == want


def test_top_n_of_nothing(spark):
    assert topn.top_n(spark.createDataFrame([], "lemma string, form string, freq bigint, row_id bigint"), "lemma", "form", "freq", "row_id").count() == 0


# --- neighbours ---


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_neighbours_find_what_goes_on_inside_a_word(spark, partitions):
    texts = ["a", "a b", "ab", "a, b", "abc", "to", "to lift", "tongue", "the ox", "the oxen", "the ox, calf", "x", "x y", "", None, "É", "Éa"]
    got = {r["text"]: r["longer"] for r in pairs.shortened(spark.createDataFrame([(t,) for t in texts], "text string"), partitions).collect()}
    assert got == {"a": "ab", "ab": "abc", "to": "tongue", "the ox": "the oxen", "x": "x y", "É": "Éa"}


# --- defects of answers ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def defects(spark):
    entries = [(1, "rōsa", "rōsa, ae, f. the flower of a garden"), (2, "Līvia", "Līvia, ae, f. Livia, a town by the river"), (3, None, None)]
    answers = {
        1: (1, None), 2: (1, " – "), 3: (1, "rosa"), 4: (1, "“Rōsa”"), 5: (1, "rosa: rosa"), 6: (1, "rōsa, ae, f."), 7: (1, "rosa, ae, f. the flower"), 8: (1, "Say in English what the word means."),
        9: (1, "I'm sorry, but I can't determine the meaning from the text."), 10: (1, "N/A"), 11: (1, "one who lifts the"), 12: (1, "die Blume des Gartens"), 13: (1, "flos hortorum"), 14: (2, "Livia, a river of a garden"),
        15: (1, "the garden of a river"), 16: (99, "rosa"), 17: (3, "one who lifts the river"), 18: (1, "rosa"), 19: (None, "the garden of a river"), 20: (1, "what kind of"),
    }
    rows = [(k, i, g, "r", "clash") for k, (i, g) in answers.items()]
    found = pairs.find_defects(
        spark.createDataFrame(rows, "rec_id bigint, idx bigint, text string, run string, body string"),
        spark.createDataFrame(entries, "idx bigint, headword string, body string"),
        spark.createDataFrame([("Say in English what the word means.\n{ENTRY}",), (None,)], "body string"),
        spark.createDataFrame(glosses() + [(f"t{k}", "a town by the river; a flower of the garden") for k in range(5)], "owner string, text string"),
    )
    return {r["rec_id"]: r["defect"] for r in found.collect()}


def test_defects(defects):
    assert defects == {1: "empty", 2: "empty", 3: "copy", 4: "copy", 5: "copy", 6: "copy", 7: "copy", 8: "copy", 9: "refusal", 10: "refusal", 11: "truncated", 12: "language", 13: "language", 16: "language", 18: "copy"}


def test_defects_of_nothing(spark):
    none = [spark.createDataFrame([], s) for s in ("rec_id bigint, idx bigint, text string, run string", "idx bigint, headword string, body string", "body string", "owner string, text string")]
    assert pairs.find_defects(*none).count() == 0


def test_shortened_equals_brute_force(spark):
    rng = random.Random(1)
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(200)})
    got = {r["text"] for r in pairs.shortened(spark.createDataFrame([(t,) for t in texts + texts[:9]] + [(None,), ("",)], "text string"), partitions=5).collect()}
    assert got == {t for t in texts if any(o != t and o.startswith(t) for o in texts)}


def test_length_limits(spark):
    rows = [("r", "x" * (10 + k % 30)) for k in range(300)] + [("r", "y" * 24) for _ in range(200)] + [("s", None)]
    assert [tuple(r) for r in pairs.length_limits(spark.createDataFrame(rows, "run string, text string")).collect()] == [("r", 24)]


# --- packing ---------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_sum_of_squares_fills_no_container_beyond_its_size(sizes):
    boxes = packing.sum_of_squares(sizes, 50)
    fill = Counter()
    for b, s in zip(boxes, sizes, strict=True):
        fill[int(b)] += s
    assert not fill or max(fill.values()) <= 50
    assert sorted(fill) == list(range(len(fill)))


def test_sum_of_squares_takes_the_least_squares():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 20, 300).tolist()
    counts, levels = Counter(), {}
    for s, b in zip(sizes, packing.sum_of_squares(sizes, 20), strict=True):
        old = levels.get(int(b), 0)

        def cost(h, s=s):
            c = counts.copy()
            if h:
                c[h] -= 1
            if h + s < 20:
                c[h + s] += 1
            return sum(v * v for v in c.values())

        assert cost(old) == min(cost(h) for h in range(20 - s + 1) if h == 0 or counts[h] > 0)
        if old:
            counts[old] -= 1
        levels[int(b)] = old + s
        if old + s < 20:
            counts[old + s] += 1


@pytest.mark.parametrize("most", [200_000, 40])
def test_packing_is_a_round_trip(spark, most):
    rng = random.Random(5)
    sizes = {i: rng.choice([0, 1, 5, 30, 100, 250, 64]) for i in range(150)} | {900: 64 * 7, 901: 64 * 3 + 1}
    df = spark.createDataFrame([(i, n, "x") for i, n in sizes.items()] + [(902, None, "x")], "doc_id bigint, n_tokens bigint, container string")
    specs = spark.createDataFrame([(1, 64), (2, 200), (3, None), (4, 0)], "spec_id int, capacity_tokens int")
    got = packing.pack(df, specs, most_items=most).collect()
    for spec, capacity in ((1, 64), (2, 200)):
        rows = [r for r in got if r["spec_id"] == spec]
        fill, pieces = Counter(), defaultdict(list)
        for r in rows:
            pieces[r["doc_id"]].append((r["piece"], r["start_token"], r["n_tokens"]))
            if r["container"]:
                fill[r["container"]] += r["n_tokens"]
        assert max(fill.values()) <= capacity
        for i, n in {**sizes, 902: 0}.items():
            at = 0
            for k, (piece, start, size) in enumerate(sorted(pieces[i])):
                assert (piece, start) == (k, at)
                at += size
            assert at == n and (len(pieces[i]) == 1 or n > capacity)
    assert {r["spec_id"] for r in got} == {1, 2}


def test_tokens_count_whole_texts(spark):
    texts = ["the garden", "", None, "rōsa " * 20_000, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    enc = tokens.encoding(tokens.TOKENIZER)
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df, "text", ["doc_id"]).collect()}
    assert got == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}


# --- mixing ----------------------------------------------------------------------------------------------


def docs(spark):
    rng = random.Random(2)
    rows = [(i, "a" if i % 3 else "b", rng.randrange(1, 60), 1.0 + i % 4) for i in range(6000)] + [(7000 + i, "c", 50, 1.0) for i in range(40)] + [(8000, None, 5, 1.0), (8001, "zzz", 5, 1.0), (8002, "a", 0, 1.0)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, w double")


TARGETS = [("a", 0.5, 1), ("b", 0.4, 2), ("c", 0.1, 5), ("none", 0.0, 1), ("gone", 0.1, 3)]


@pytest.mark.parametrize("weight", [None, "w"])
def test_mix_reaches_its_shares_under_the_caps(spark, weight):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mixed = mixing.pareto_mix(docs(spark), targets, weight=weight, per_bin=50).cache()
    report = {r["source"]: r for r in mixing.mix_report(mixed, targets).collect()}
    for source, share, cap in TARGETS[:3]:
        assert report[source]["actual_share"] == pytest.approx(share, abs=2e-3)
        assert report[source]["most_copies"] <= cap
    assert report["gone"]["n_tokens"] == 0 and report["none"]["n_tokens"] == 0
    assert mixed.groupBy("doc_id").count().where("count > 1").count() == 0
    again = mixing.pareto_mix(docs(spark).repartition(3), targets, weight=weight, per_bin=50)
    assert mixed.exceptAll(again).count() == 0 and again.exceptAll(mixed).count() == 0
    mixed.unpersist()


def test_pareto_order_prefers_heavier_records(spark):
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.7, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.pareto_mix(docs(spark), targets, weight="w").where("source = 'a'")
    taken = {r["doc_id"] for r in mixed.collect()}
    rate = [np.mean([i in taken for i in range(6000) if i % 3 and i % 4 == k]) for k in (0, 3)]
    assert 2.5 < rate[1] / rate[0] < 6


def test_a_record_larger_than_all_the_room_is_not_drawn(spark):
    sizes = spark.createDataFrame([(1, "a", 743), (2, "a", 743), (3, "a", 168), (4, "b", 100), (5, "b", None), (6, "a", 20)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.65, 1), ("b", 0.35, 1)], "source string, target_share double, max_repeats int")
    assert {r["doc_id"]: r["copies"] for r in mixing.pareto_mix(sizes, targets).collect()} == {3: 1, 4: 1, 6: 1}


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    empty = docs(spark).where("false")
    assert mixing.pareto_mix(empty, targets).count() == 0
    assert mixing.mix_report(mixing.pareto_mix(empty, targets), targets).count() == 5


# --- personal information --------------------------------------------------------------------------------

NAMES = [(a + b, "family") for a in ("Ash", "Bel", "Kess", "Wex") for b in ("bourne", "ier", "stad", "vorn")] + [(n, "given") for n in ("Anna", "Grace", "Mark", "Tomás", "Victor", "Will")] + [(None, "given"), ("", "family"), ("Anna", "given")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("I saw Anna Belstad here", [("name", "Anna Belstad")]),
        ("Dr K. Wexier disagrees", [("name", "K. Wexier")]),
        ("Prof. Katrin van Ashvorn came", [("name", "Katrin van Ashvorn")]),
        ("by KESSTAD, Anna; and", [("name", "KESSTAD, Anna")] if False else [("name", "KESSSTAD, Anna")]),
        ("Ashbourne, Tomás|x", [("name", "Ashbourne, Tomás")]),
        ("Victor Road signs, Mark Latin vowels, Will the pointer, Grace notes", []),
        ("Belstad is a town", []),
        ("write to anna.belstad@mail.example, now", [("email", "anna.belstad@mail.example")]),
        ("x_y [at] a [dot] example [dot] org.", [("email", "x_y [at] a [dot] example [dot] org")]),
        ("a noun @ position 58. key foo@63 was", []),
        ("mailto:A1@B.TEST", [("email", "A1@B.TEST")]),
        ("call +44 7700 900638 ext. 4!", [("phone", "+44 7700 900638 ext. 4")]),
        ("fax (212) 555-0191, 01 99 00 73 16; 030/23125-237", [("phone", "(212) 555-0191"), ("phone", "01 99 00 73 16"), ("phone", "030/23125-237")]),
        ("Range 9511-52683 of 01.11.19599, mark 99.7168.361, Hash 92894251873, on 5/4/2023", []),
        ("my SSN: 945-40-6804. See slip 256-63-5653 in", [("id_number", "945-40-6804")]),
        ("passport no. ZZ1234567, DNI 99.435.725D, QQ 12 34 56 C, QQ 96 18", [("id_number", "ZZ1234567"), ("id_number", "99.435.725D"), ("id_number", "QQ 12 34 56 C")]),
        ("at 108 North Heron Drive, Apt 3.", [("address", "108 North Heron Drive, Apt 3")]),
        ("in der Tamsinstraße 104, 01368 Corvane", [("address", "Tamsinstraße 104, 01368 Corvane")]),
        ("au 235, rue du Quillon, 99232 Altenborn", [("address", "235, rue du Quillon, 99232 Altenborn")]),
        ("Via Brindle 60, Grauental. The Via Appia crosses it at stone 360. Some 188 Street names", [("address", "Via Brindle 60, Grauental")]),
        ("", []),
    ],
)
def test_items(text, want):
    text = text.replace("KESSTAD", "KESSSTAD")
    finder = Finder(NameBook.of(NAMES))
    items = finder.find(text)
    assert [(k, text[s:e]) for s, e, k in items] == want
    back, at = replace(text, items), 0
    for s, e, _ in items:  # all else stays as it is
        assert text[at:s] in back
        at = e


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_items_never_overlap(text):
    items = Finder(NameBook.of(NAMES)).find(text)
    assert all(a[1] <= b[0] for a, b in zip(items, items[1:], strict=False))
    assert all(0 <= s < e <= len(text) for s, e, _ in items)


def test_frames(spark):
    long = "İ" * 50_000 + " Anna Belstad " + "x" * 50_000
    df = spark.createDataFrame([(1, "Anna Belstad", "c"), (1, "Anna Belstad", "c"), (2, None, "c"), (3, "", "c"), (4, long, "c")], "doc_id bigint, text string, pii_type string")
    names = spark.createDataFrame(NAMES, "name string, kind string")
    assert sorted((r["doc_id"], r["start_pos"]) for r in find_pii(df, "doc_id", "text", names).collect()) == [(1, 1), (1, 1), (4, 50_002)]
    assert {(r["doc_id"], r["n_items"]) for r in redact(df, "doc_id", "text", names).collect()} == {(1, 1), (2, 0), (3, 0), (4, 1)}
    assert find_pii(df, "doc_id", "text", names.where("false")).count() == 0
    with pytest.raises(ValueError, match="more than"):
        find_pii(df, "doc_id", "text", names, most_names=3)


@pytest.mark.parametrize(
    "text, phones",
    [
        ("call (415) 555-0132 / (415) 555-0133", ["(415) 555-0132", "(415) 555-0133"]),
        ("01632 960 482 - 01632 960 483.", ["01632 960 482", "01632 960 483"]),
        ("flat 12 (020) 7946 0018", ["(020) 7946 0018"]),
        ("room 12 020 7946 0018", ["020 7946 0018"]),
        ("415-555-0132 415-555-0133 415-555-0134", ["415-555-0132", "415-555-0133", "415-555-0134"]),
        ("2024-01-15 415-555-0132", ["415-555-0132"]),
        ("01 99 00 73 16 01 99 00 73 17", ["01 99 00 73 16", "01 99 00 73 17"]),
        ("123 456 789 0123 4567; 4111 0123 4567 8901; 978-0-415-55501-3", []),
    ],
)
def test_every_number_of_a_digit_run(text, phones):
    assert [text[a:b] for a, b, kind in Finder(NameBook.of(NAMES)).find(text) if kind == "phone"] == phones


def test_long_digit_runs_are_linear():
    finder = Finder(NameBook.of(NAMES))
    assert finder.find("1 " * 100_000) == [] and len(finder.find("01 " * 50_000)) == 10_000


@pytest.mark.parametrize(
    "text, want",
    [
        ("write mailto:jane%40mail.example.", [("email", "jane%40mail.example")]),
        ("<mailto:j.doe@mail.example?subject=x>", [("email", "j.doe@mail.example")]),
        ("TEL:4155550132 or tel:+14155550132;ext=12", [("phone", "4155550132"), ("phone", "+14155550132;ext=12")]),
        ("hotel:4155550132, tel:2024", []),
    ],
)
def test_links(text, want):
    assert [(k, text[a:b]) for a, b, k in Finder(NameBook.of(NAMES)).find(text)] == want


@pytest.mark.parametrize(
    "text, names",
    [
        ("Dr. Anna Kowalski came", ["Anna Kowalski"]),
        ("Contact: Anna M. van Kowalski, please", ["Anna M. van Kowalski"]),
        ("Anna Kowalski <x@mail.example>", ["Anna Kowalski"]),
        ("Anna Kowalski, (212) 555-0191", ["Anna Kowalski"]),
        ("Anna Latin vowels, From Anna Latin, Mr Anna Road", []),
    ],
)
def test_family_names_of_any_form(text, names):
    assert [text[a:b] for a, b, k in Finder(NameBook.of([*NAMES, ("Anna", "given")])).find(text) if k == "name"] == names


# --- personal information: long items, checks, cost -------------------------------------------------------

FINDER = Finder(NameBook.of([(n, "family") for n in ("Ashmere", "Ashford", "Ashwell", "Oakmere", "Oakford", "Oakwell", "Elmmere", "Elmford", "Elmwell")] + [("Anna", "given")]))


def kinds(text):
    return [(k, text[s:e]) for s, e, k in FINDER.find(text)]


def test_long_items_are_found_whole():
    mail = "x" * 300 + "@" + "abc." * 70 + "org"
    assert kinds(f"write to {mail} now") == [("email", mail)]
    assert FINDER.find(f"mailto:{mail} now") and replace(f"<{mail}>", FINDER.find(f"<{mail}>")) == "<[EMAIL]>"
    street = f"12 {'Ab' * 200} Street"
    assert kinds(f"at {street} there") == [("address", street)]
    given = "A" + "n" * 200
    assert kinds(f"by {given} Ashmere here") == [("name", f"{given} Ashmere")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SSN 000-12-3456", []), ("SSN 123-45-6789", [("id_number", "123-45-6789")]), ("DNI 12345678A", []), ("DNI 12345678Z", [("id_number", "12345678Z")]), ("12345678A", []), ("12345678Z", [("id_number", "12345678Z")]),
        ("pay DE89 3704 0044 0532 0130 00 now", [("id_number", "DE89 3704 0044 0532 0130 00")]), ("pay DE88 3704 0044 0532 0130 00 now", []), ("with 4111 1111 1111 1111.", [("id_number", "4111 1111 1111 1111")]), ("with 4111 1111 1111 1112.", []),
        ("account number 12345678", [("id_number", "12345678")]), ("code AB1234567", []), ("passport AB1234567", [("id_number", "AB1234567")]), ("https://bob:pw@host.example.org/x", []), ("ftp://bob@host.example.org", []), ("mailto:bob@host.example.org", [("email", "bob@host.example.org")]),
        ("2 55 08 14 168 025 38", [("id_number", "2 55 08 14 168 025 38")]), ("2 55 08 14 168 025 39", []),
    ],
)
def test_numbers_are_checked(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize("unit", ["12 Oak Street, London ", "bob@example.org ", "Anna Ashmere ", "weg", "4111 1111 ", "a@", "{at}", "12 Oak Street", "card 12 "])
def test_cost_is_linear_in_the_text(unit):
    import time

    def seconds(n):
        text, start = unit * (n // len(unit)), time.perf_counter()
        FINDER.find(text)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(1_000_000) < 20 * seconds(125_000) + 0.5
