from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from glossaria.operators import checkpoint, diffing, judging, paradigms, pointers, ranking, sampling, skew
from glossaria.operators.orphans import Reference, find_orphans, life_spans, orphan_report

REFS = "row_id bigint, key string, at timestamp_ntz, added_at string"
TARGET = "key string, added_at timestamp_ntz, removed_at timestamp_ntz, row_id string"


def day(n):
    return None if n is None else dt.datetime(2023, 1, 1) + dt.timedelta(days=n)


def brute(rows, targets):
    out = set()
    for row_id, key, at, *_ in rows:
        if key is None:
            continue
        mine = [t for t in targets if t[0] == key]
        if at is not None and any(a is not None and a <= at and (r is None or r > at) for _, a, r, *_ in mine):
            continue
        added = [a for _, a, _, *_ in mine if a is not None]
        reason = "missing" if not added else "late" if at is not None and min(added) > at else "deleted"
        out.add((row_id, reason))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_orphans_equal_brute_force(spark, hot):
    rng = random.Random(4)
    targets = [(f"k{rng.randrange(20)}", day(rng.randrange(60)), rng.choice([None, day(rng.randrange(30, 120))]), "x") for _ in range(40)]
    targets += targets[:5]
    rows = [(i, "k3" if hot and i % 3 == 0 else rng.choice([None, "", f"k{rng.randrange(26)}"]), day(rng.randrange(130)), "clash") for i in range(600)]
    rows += [(900, "k1", None, "x"), (901, None, None, "x")]
    got = find_orphans(spark.createDataFrame(rows, REFS), "row_id", "at", [Reference("key", spark.createDataFrame(targets, TARGET), "key")], heavy_parts=4, least_rows=10 if hot else 10_000)
    assert {(r["row_id"], r["reason"]) for r in got.collect()} == brute(rows, targets)
    assert got.count() == len(brute(rows, targets))


def test_orphans_of_empty_tables(spark):
    none, some = spark.createDataFrame([], TARGET), spark.createDataFrame([(1, "a", day(1), "x")], REFS)
    assert [r["reason"] for r in find_orphans(some, "row_id", "at", [Reference("key", none, "key")]).collect()] == ["missing"]
    assert find_orphans(spark.createDataFrame([], REFS), "row_id", "at", [Reference("key", none, "key")]).count() == 0


def test_orphan_report_counts(spark):
    rows = [(1, "a", day(1), ""), (2, "a", day(40), ""), (3, "b", day(2), ""), (3, "b", day(2), "")]
    got = orphan_report(spark.createDataFrame(rows, REFS), "row_id", "at", [Reference("key", spark.createDataFrame([("a", day(5), None, "")], TARGET), "key")])
    assert {(r["period"], r["n_refs"], r["n_missing"], r["n_late"]) for r in got.collect()} == {("2023-01", 3, 2, 1), ("2023-02", 1, 0, 0)}


def test_life_spans_merge(spark):
    rows = [("a", day(0), day(10), ""), ("a", day(5), day(20), ""), ("a", day(20), day(30), ""), ("a", day(40), None, ""), ("a", day(50), day(60), ""), ("a", day(7), day(7), ""), (None, day(1), None, "")]
    got = sorted((r["_from"], r["_to"].year) for r in life_spans(spark.createDataFrame(rows, TARGET), "key").collect())
    assert got == [(day(0), 2023), (day(40), 9999)]


@pytest.mark.parametrize("least", [5, 10_000])
def test_lookup_join_keeps_every_row(spark, least):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else "x") for i in range(90)], "id int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("y", 2)], "k string, v int")
    got = skew.lookup_join(rows, lookup, "k", parts=4, least_rows=least)
    assert got.count() == 90 and got.where("v = 1").count() == 60 and got.where("v is null").count() == 30


def entries(spark, rows):
    return spark.createDataFrame(rows, "idx bigint, key string, head string")


def test_first_entry_wins_and_numbers(spark):
    e = entries(spark, [(0, "repens1", "rēpens"), (1, "repens2", "repens"), (2, "solus", "sōlus"), (3, "x", "Sōlus"), (4, "", "")])
    index = pointers.first_wins_index(e, "idx", "key", "head")
    assert {(r["word"], r["idx"]) for r in index.collect()} == {("repens", 0), ("solus", 2), ("x", 3)}
    refs = spark.createDataFrame([(2, "repens", 2), (2, "solus", None), (3, "solus", None), (3, "nobody", 1)], "src bigint, word string, number int")
    got = pointers.resolve_targets(refs, index, pointers.numbered_index(e, "idx", "key"))
    assert {(r["src"], r["dst"]) for r in got.collect()} == {(2, 1), (3, 2)}


def test_chase_is_bounded_and_never_circles(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (10, 11), (11, 10), (20, 20), (30, 1)]
    e = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = pointers.chase(e.select("src"), e, spark.createDataFrame([(5,), (6,)], "node bigint"))
    assert {(r["src"], r["dst"], r["hops"]) for r in got.collect()} == {(1, 5, 4), (2, 5, 3), (3, 5, 2), (4, 5, 1), (5, 6, 1)}


def test_rankings(spark):
    df = spark.createDataFrame([("f", "a", 0.5, 3), ("f", "b", 0.9, 2), ("f", "c", 0.9, 1), ("f", "d", 0.1, 0)], "form string, lemma string, conf double, ord int")
    best = ranking.top_k(df, ["form"], [F.col("conf").desc(), F.col("ord")], 3)
    assert [r["lemma"] for r in best.orderBy("rank").collect()] == ["c", "b", "a"]
    assert ranking.keep_best(df, ["form"], "conf", "ord", ["lemma"]).first()["lemma"] == "c"
    names = ranking.numbered_names(df, "form", [F.col("conf").desc(), F.col("ord")])
    assert {(r["lemma"], r["name"]) for r in names.collect()} == {("c", "f"), ("b", "f2"), ("a", "f3"), ("d", "f4")}
    assert [r["lemma"] for r in ranking.frequency_band(df, "conf", "lemma", 1, 2).collect()] == ["b", "a"]


def test_weights_and_majority(one, spark):
    assert one(ranking.frequency_weight(F.col("n")), n=0) == 0.5
    assert one(ranking.frequency_weight(F.col("n")), n=10**7) == 1.0
    df = spark.createDataFrame([("f", "a", 8, 0.5), ("f", "b", 4, 0.95), ("g", "a", 2, 0.5), ("g", "b", 1, 0.95)], "form string, lemma string, k int, conf double")
    got = {(r["form"], r["lemma"]): r["conf"] for r in ranking.majority_leads(df, "form", "lemma", "k", "conf").collect()}
    assert got == {("f", "a"): 1.0, ("f", "b"): 0.89, ("g", "a"): 0.5, ("g", "b"): 0.95}


@pytest.mark.parametrize(("a", "b", "want"), [(5, None, "unjudged"), (2, 1, "both-bad"), (5, 2, "disagree"), (4, 4, "judgeB-ok"), (3, 3, "weak"), (1, 3, "weak"), (1, 4, "disagree")])
def test_consensus(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a int, b int")
    assert df.select(judging.consensus(F.col("a"), F.col("b"))).first()[0] == want


def test_verdicts(spark, one):
    df = spark.createDataFrame([(3, 4), (3, 2), (3, 3), (None, 1), (3, None)], "b int, a int")
    assert [r[0] for r in df.select(judging.verify(F.col("b"), F.col("a"))).collect()] == ["keep", "revert", "flag", "flag", "todo"]
    assert one(judging.mark_once(F.col("s"), "!"), s="model!") == "model!"
    assert one(judging.worst_valid(F.lit(3), F.lit(-1), F.lit(2))) == 2
    words = lambda *w: F.array(*map(F.lit, w)) if w else F.array().cast("array<string>")
    assert [one(judging.overlap_verdict(*p)) for p in ((words("a", "b"), words("a", "b", "c")), (words("a", "b", "c"), words("a", "b", "d")), (words("a"), words("b")), (words(), words("b")))] == ["PASS", "REVIEW", "FAIL", "EMPTY"]


@pytest.mark.parametrize(("kind", "old", "new", "s0", "s1", "want"), [("count", 5, 7, 0.1, 0.2, "worse"), ("count", 5, 7, 0.1, 0.1, "scale"), ("count", 5, 3, 0.1, 0.1, "better"), ("coverage", 0.9, 0.8, 0.0, 0.0, "worse"), ("info", 1, 9, 0.0, 1.0, "info"), ("count", 5, 5, 0.1, 0.1, "same")])
def test_metric_change(one, kind, old, new, s0, s1, want):
    assert one(judging.metric_change(*[F.lit(v) for v in (kind, old, new, s0, s1)])) == want


def test_diff_and_log(spark):
    b = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3"), ("d", "4")], "k string, v string")
    a = spark.createDataFrame([("a", "1"), ("b", None), ("c", "x"), ("e", None)], "k string, v string")
    assert {(r["k"], r["change"]) for r in diffing.diff(b, a, "k", "v").collect()} == {("c", "changed"), ("d", "removed"), ("e", "added")}
    log = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, 1, None)], "i int, n int, g string")
    assert {(r["i"], r["g"]) for r in checkpoint.latest(log, ["i"], "n", ["g"]).collect()} == {(1, "z"), (2, None)}
    assert [r["i"] for r in checkpoint.todo(spark.createDataFrame([(1,), (7,)], "i int"), log, ["i"]).collect()] == [7]


def test_samples_repeat(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    first = [r["id"] for r in sampling.hash_sample(df, "id", 10).collect()]
    assert first == [r["id"] for r in sampling.hash_sample(df.repartition(7), "id", 10).collect()] and len(set(first)) == 10
    assert sampling.systematic_sample(df, "g", "id", 10, 3).count() == 10


def test_paradigms(spark):
    e = spark.createDataFrame([(1, "portă", "portă, ae, f. a gate"), (2, "ămo", "ămo, āvi, ātum, 1, v. a. to love"), (3, "hortŏr", "hortŏr, ātus, 1, v. dep. to urge"), (4, "et", "et, conj. and"), (5, None, None), (6, "a", "a, ae, f. x")], "idx bigint, headword string, body string")
    cells = {(r["idx"], r["form"]): r["cell"] for r in paradigms.expand(e).collect()}
    assert cells[1, "portae"] == "dat s f|gen s f|nom p f|voc p f"
    assert cells[2, "amat"] == "3 s pres active ind" and cells[2, "amare"] == "0 pres active inf"
    assert cells[2, "amauit"] == "3 s perf active ind"
    assert (3, "hortatur") in cells and (3, "hortat") not in cells
    assert {i for i, _ in cells} == {1, 2, 3}
    assert len(paradigms.verb_rules()) > 300


def test_pointers_pass_rejection_and_function_words_on(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (5, 6), (6, 5), (7, 1)], "src bigint, dst bigint")
    short = spark.createDataFrame([(n,) for n in (1, 2, 5, 6, 7)], "node bigint")
    targets = pointers.last_targets(edges, short)
    assert {tuple(r) for r in targets.collect()} == {(1, 3), (2, 3), (5, 6), (6, 5), (7, 3)}
    rejected = spark.createDataFrame([(3,), (5,)], "node bigint")
    assert {r[0] for r in pointers.inherit_rejection(rejected, targets).collect()} == {1, 2, 6, 7}
    one = spark.createDataFrame([(1, 2), (2, 3)], "src bigint, dst bigint")
    assert {r[0] for r in pointers.inherit_rejection(rejected, one).collect()} == {2}  # one hop
    words = spark.createDataFrame(
        [(1, "uti", "uti, v. ut init."), (2, "sum-", "sum-, v. sub"), (3, "ut", "ut, conj. that " + "x" * 90), (4, "porta", "porta, ae, f. a gate"), (5, "sum", "sum = eum, v. is"), (6, None, None)],
        "idx bigint, headword string, body string",
    )
    to = spark.createDataFrame([(1, 3), (2, 3), (5, 3), (4, 1)], "src bigint, dst bigint")
    assert {r[0] for r in pointers.function_words(words, to).collect()} == {1, 3}


def test_shorten_and_carry(one):
    assert one(judging.shorten_accepted(F.col("a"), F.col("b")), a="to go away", b="go off") and not one(judging.shorten_accepted(F.col("a"), F.col("b")), a="go", b="to go")
    assert not one(judging.shorten_accepted(F.col("a"), F.col("b")), a="go", b=" ")
    assert one(judging.carried(F.col("s"), F.col("g"), F.col("q")), s="model", g="gate", q="xrefix~") and not one(judging.carried(F.col("s"), F.col("g"), F.col("q")), s="model", g="gate", q="model")


@pytest.mark.parametrize(
    ("source", "gloss", "reasons", "own", "target", "want"),
    [
        ("model", " ", [], None, None, "no gloss"), ("model!", "x", [], None, None, "unresolved"), ("model?", "x", [], None, None, "ungrounded"), ("model", "x", ["ungrounded"], None, None, "ungrounded"), ("model", "x", ["etymology-leak"], None, None, "detector"),
        ("model", "x", ["latin-chars"], None, None, "shipped"), ("xref-resolved", "great", [], "adv", "adj", "adverb"), ("xref-resolved", "great", [], "adv", None, "adverb"), ("xref-resolved", "more", [], "adv", "adv", "shipped"), ("model", "great", [], "adv", "adj", "shipped"), ("tr", "Rosa", [], None, None, "echo"),
    ],
)
def test_ship_reason(spark, source, gloss, reasons, own, target, want):
    df = spark.createDataFrame([(source, gloss, "rosa", reasons, own, target)], "source string, gloss string, lemma string, reasons array<string>, own string, target string")
    assert df.select(judging.ship_reason(*[F.col(c) for c in df.columns]).alias("r")).first()[0] == want


def test_repair_reason_and_scores(spark):
    df = spark.createDataFrame([(None, [], 5), ("x", ["fragment", "y"], 5), ("x", [], 2), ("x", [], -1), ("x", [], 4), ("x", [], None)], "g string, r array<string>, s int")
    got = [r[0] for r in df.select(judging.repair_reason(F.col("g"), F.col("r"), F.col("s"), 2)).collect()]
    assert got == ["empty", "fragment", "judge", None, None, None]
    assert [r[0] for r in df.select(judging.scores_pass(F.col("s"), 3)).collect()] == [True, True, False, False, True, True]


def test_salted_joins_equal_plain_ones(spark):
    from glossaria.operators import skew

    rows = spark.createDataFrame([(k, "hot" if k % 3 else f"c{k}") for k in range(300)] + [(900, None)], "id int, key string")
    other = spark.createDataFrame([("hot", 1), ("c3", 2), ("c6", 3)], "key string, v int")
    hot = skew.hot_hashes(rows.where("key is not null").groupBy("key").count().withColumnRenamed("count", "n"), ["key"], least_rows=50)
    assert len(hot) == 1
    for how in ("left", "left_semi", "left_anti", "inner"):
        want = sorted(map(str, rows.join(other, "key", how).select("id").collect()))
        assert sorted(map(str, skew.spread_join(rows.where("key is not null"), other, ["key"], how, hot).select("id").collect() + (rows.where("key is null").select("id").collect() if how in ("left", "left_anti") else []))) == want
    assert skew.lookup_join(rows, other, "key", least_rows=50).where("v = 1").count() == 200
    assert skew.heavy_values(rows, "key", least_rows=50) == ["hot"]


def test_orphans_of_a_hot_key_with_many_spans(spark):
    from glossaria.operators.orphans import Reference, find_orphans

    target = spark.range(0, 200, 2).selectExpr("'hot' as key", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id as int)) as added_at", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id + 1 as int)) as removed_at")
    rows = spark.range(400).selectExpr("id as row_id", "'hot' as k", "timestamp_ntz '2024-01-01 06:00:00' + make_dt_interval(cast(id % 200 as int)) as at")
    found = [find_orphans(rows, "row_id", "at", [Reference("k", target, "key")], least_rows=10, most_broadcast=most) for most in (5, 10_000)]
    a, b = ({(r["row_id"], r["reason"]) for r in f.collect()} for f in found)
    assert a == b == {(i, "deleted") for i in range(400) if i % 2}
