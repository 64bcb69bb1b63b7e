from __future__ import annotations

import json
import zipfile

from pyspark.sql import functions as F

from glossaria.sources import files, sinks


def test_tsv_and_frequencies(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("# form\tn\net\t12\n\nin\t7\nbad\tx\net\t1\nshort\n")
    rows = files.read_tsv(spark, str(tmp_path / "f.tsv"), ["form", "n"]).orderBy("line_no").collect()
    assert [r["form"] for r in rows] == ["et", "in", "bad", "et"] and len({r["line_no"] for r in rows}) == 4
    assert {(r["form"], r["n"]) for r in files.read_frequencies(spark, str(tmp_path / "f.tsv")).collect()} == {("et", 13), ("in", 7)}


def test_scores_last_line_counts(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("k\th\tg\ts\t3\twhy\nk\th\tg\ts\tx\twhy\nk\th\tg2\ts\t5\n")
    assert [(r["gloss"], r["score"], r["reason"]) for r in files.read_scores(spark, str(tmp_path / "s.tsv")).collect()] == [("g2", 5, None)]


def test_dictionary(spark, tmp_path):
    (tmp_path / "d.xml").write_text('<x><entryFree key="a1"><orth>ā</orth>, <tr>from</tr>\n <tr>by</tr></entryFree><entryFree key="b">no head</entryFree></x>')
    rows = files.read_dictionary(spark, str(tmp_path / "d.xml")).orderBy("pos").collect()
    assert [(r["key"], r["headword"], r["translations"], r["body"]) for r in rows] == [("a1", "ā", ["from", "by"], "ā, from by"), ("b", "b", [], "no head")]


def test_corpus_and_treebank(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "w-lat1.xml").write_text("<teiHeader>skip</teiHeader><p>arma <note>no\nno</note>virumque</p>")
    (tmp_path / "w-eng1.xml").write_text("<p>other</p>")
    assert [r["text"] for r in files.read_corpus(spark, str(tmp_path)).collect()] == ["arma virumque"]
    (tmp_path / "t.xml").write_text('<word form="est" lemma="sum1" postag="v3spia---"/><word form="x" postag="n"/>')
    assert [(r["form"], r["lemma"]) for r in files.read_treebank(spark, str(tmp_path / "t.xml")).collect()] == [("est", "sum")]


def test_log_latest_wins(spark, tmp_path):
    lines = [{"i": 1, "g": "a"}, {"i": 1, "p": "hard", "g": "b"}, {"i": 1, "g": "c"}, {"i": 2, "g": "d", "in": "x"}]
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, lines)) + '\n{"i": 3, "g"')
    got = files.read_log(spark, str(tmp_path / "l.jsonl"), "main")
    assert {(r["i"], r["g"], r["in"]) for r in got.collect()} == {(1, "c", None), (2, "d", "x")}
    sinks.write_log(spark.createDataFrame([(1, "a"), (2, None)], "i bigint, g string"), str(tmp_path / "log"))
    assert files.read_log(spark, str(tmp_path / "log" / "*.json")).count() == 1


def test_package_round_trip(spark, tmp_path):
    forms = spark.createDataFrame([("rosa", "rosa", 0.855, 'a "b", c'), ("rosae", "rosa", 1.0, None)], "word_form string, lemma string, confidence double, note string")
    paths = [str(tmp_path / f"p{k}.zip") for k in (1, 2)]
    for path in paths:
        assert sinks.write_package(path, {"morphology.csv": (forms.repartition(3), ["word_form", "lemma"]), "rules.csv": (spark.createDataFrame(sinks.PACKAGE_RULES, "language string, pattern string, replacement string, description string, priority int"), ["priority", "pattern"])}) == {"morphology.csv": 2, "rules.csv": 8}
    assert open(paths[0], "rb").read() == open(paths[1], "rb").read()
    with zipfile.ZipFile(paths[0]) as z:
        assert z.read("morphology.csv").decode().splitlines()[1].startswith('rosa,rosa,0.8')
    rows = files.read_zip_csv(spark, paths[0], "morphology.csv").orderBy("line_no").collect()
    assert [r["fields"]["note"] for r in rows] == ['a "b", c', ""]


def test_tsv_and_manifest_out(spark, tmp_path):
    df = spark.createDataFrame([("b", "x\ty"), ("a", None)], "key string, gloss string")
    sinks.write_tsv(df, str(tmp_path / "out"), ["key", "gloss"], ["key"])
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).orderBy("value").collect()] == ["a\t", "b\tx y"]
    m = sinks.write_manifest(df.withColumn("source", F.lit("rules")), str(tmp_path / "m.json"), prompt="abc")
    many = spark.range(1500).select(F.concat(F.lit("feed"), "id").alias("source"))
    assert sinks.write_manifest(many, str(tmp_path / "m2.json"))["rows"] == 1500 == len(json.load(open(tmp_path / "m2.json"))["sources"])
    assert sinks.changed_settings(str(tmp_path / "m.json"), prompt="abd", other=1) == {"prompt": ("abc", "abd")}
    assert sinks.changed_settings(str(tmp_path / "none.json"), prompt="x") == {}
    assert m["sources"] == {"rules": 2} and json.load(open(tmp_path / "m.json"))["prompt"] == "abc"


def test_small_readers_and_writers(spark, tmp_path):
    (tmp_path / "gold.tsv").write_text("# key\tgold\na\tlove\nb\thate\na\tlike\n")
    assert {tuple(r) for r in files.read_gold(spark, str(tmp_path / "gold.tsv")).collect()} == {("a", "like"), ("b", "hate")}
    (tmp_path / "base.tsv").write_text("# probe: 2 rows\nk\tx\ty\nl\n")
    assert {tuple(r) for r in files.read_baseline(spark, str(tmp_path / "base.tsv")).collect()} == {("k", "x\ty"), ("l", "")}
    assert files.read_baseline(spark, str(tmp_path / "gone.tsv")).count() == files.read_lemma_map(spark, str(tmp_path / "gone.tsv")).count() == files.read_replies(spark, str(tmp_path / "gone")).count() == 0
    lines = [{"i": 1, "g": " a\n b "}, {"i": 1, "p": "hard", "g": "c"}, {"i": 2, "g": " "}, {"i": 1, "g": "d"}]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{bad")
    assert {tuple(r) for r in files.read_replies(spark, str(tmp_path / "r.jsonl")).collect()} == {("main:1", "d"), ("hard:1", "c")}
    (tmp_path / "p.txt").write_text("\n Say {HEAD}.\n")
    assert files.read_prompt(spark, str(tmp_path / "p.txt")) == "Say {HEAD}."
    assert files.resolve("p.txt", str(tmp_path)) == str(tmp_path / "p.txt") and files.resolve("/x/y") == "/x/y" and files.resolve("none", "/x") == "none"
    sinks.write_frequencies(spark.createDataFrame([("et", 3), ("in", 5), ("ab", 1)], "form string, n bigint"), str(tmp_path / "freq"), least=2)
    assert [r["form"] for r in files.read_ranked(spark, str(tmp_path / "freq")).orderBy("path", "line_no").collect()] == ["in", "et"]
    (tmp_path / "f.tsv").write_text("Vir\t2\nuir\t3\n")
    assert [tuple(r) for r in files.read_frequencies(spark, str(tmp_path / "f.tsv")).collect()] == [("uir", 5)]
    sinks.write_baseline(spark.createDataFrame([("b", "2"), ("a", "1")], "key string, value string"), str(tmp_path / "probe"), "forms")
    assert spark.read.text(str(tmp_path / "probe" / "head")).first()[0] == "# forms: 2 rows"


def test_rewrite_keeps_comments_and_order(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("# one\nk\th\ta bad bad\ts\tmore\nshort\n# two\nl\th\tgood\ts\n")

    def change(rows):
        return rows.withColumn("gloss", F.replace("gloss", F.lit("bad bad"), F.lit("bad")))

    names = ["key", "headword", "gloss", "source"]
    assert [r["new"] for r in sinks.rewrite_tsv(spark, str(tmp_path / "g.tsv"), names, change, str(tmp_path / "dry"), dry_run=True).collect()] == ["k\th\ta bad\ts\tmore"]
    assert not (tmp_path / "dry").exists()
    sinks.rewrite_tsv(spark, str(tmp_path / "g.tsv"), names, change, str(tmp_path / "new"))
    written = [line for part in sorted((tmp_path / "new").glob("part-*")) for line in part.read_text().splitlines()]
    assert written == ["# one", "k\th\ta bad\ts\tmore", "short", "# two", "l\th\tgood\ts"]


def test_latest_stream_over_several_batches(spark, tmp_path):
    from glossaria.streaming import events as S

    for k in range(3):
        spark.createDataFrame([(k * 10 + j, j % 2, float(k)) for j in range(4)], "event_id bigint, user_id bigint, value double").selectExpr("event_id", "timestamp_ntz '2024-01-01 00:00:00' as ts", "user_id", "'a' as event_type", "value", "'{}' as props").coalesce(1).write.mode("append").parquet(str(tmp_path / "e.parquet"))
    stream = S.event_stream(spark, str(tmp_path / "e.parquet"), files_per_batch=1)
    got = S.latest_table(stream, ["user_id"], "event_id", ["value"], "t")
    assert {(r["user_id"], r["event_id"], r["value"]) for r in got.collect()} == {(0, 22, 2.0), (1, 23, 2.0)}


def _events(spark, path, rows):
    df = spark.createDataFrame(rows, "event_id bigint, at string, user_id bigint, value double")
    df.selectExpr("event_id", "cast(at as timestamp_ntz) as ts", "user_id", "'a' as event_type", "value", "'{}' as props").coalesce(1).write.mode("append").parquet(path)


def test_latest_table_goes_on_after_a_restart(spark, tmp_path):
    from glossaria.streaming import events as S

    path, root = str(tmp_path / "e.parquet"), f"file://{tmp_path}/state"
    for k in range(5):
        _events(spark, path, [(k * 10 + j, "2024-01-01 00:00:00", j % 2, float(k)) for j in range(4)])
        got = S.latest_table(S.event_stream(spark, path, files_per_batch=1), ["user_id"], "event_id", ["value"], "t", root=root, compact_every=2)
        assert {(r["user_id"], r["event_id"], r["value"]) for r in got.collect()} == {(0, k * 10 + 2, float(k)), (1, k * 10 + 3, float(k))}
    assert len(list((tmp_path / "state").glob("delta-*"))) <= 3


def test_late_events_are_dropped(spark, tmp_path):
    import time

    from glossaria.streaming import events as S

    path = str(tmp_path / "e.parquet")
    for rows in ([(1, "2024-01-01 10:10:00", 1, 1.0)], [(2, "2024-01-01 15:10:00", 1, 1.0)], [(5, "2024-01-01 15:20:00", 1, 1.0)], [(3, "2024-01-01 10:20:00", 1, 1.0), (4, "2024-01-01 20:00:00", 1, 1.0)]):
        _events(spark, path, rows)
        time.sleep(1.1)
    said = []
    listener = S.Progress(said.append, every=1)
    spark.streams.addListener(listener)
    got = S.to_table(S.tumbling(S.event_stream(spark, path, files_per_batch=1), late="2 hours"), "late", "append")
    spark.streams.removeListener(listener)
    # the event of 10:20 comes after the watermark of 13:10: its window keeps the one event it had
    assert {(r["hour"].hour, r["n"]) for r in got.collect()} == {(10, 1), (15, 2)}
    assert listener.rows == 5
