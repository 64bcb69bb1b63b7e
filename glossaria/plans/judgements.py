"""Answers, judgements and snapshots: the log, verdicts, defects, repairs and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.functions import quality as Q
from glossaria.functions import text as T
from glossaria.functions.readings import cell_state, merge_readings, tag_reading
from glossaria.functions import names
from glossaria.operators import checkpoint, diffing, judging, sampling, stages
from glossaria.operators.pointers import function_words as find_function_words
from glossaria.operators.pointers import inherit_rejection, last_targets
from glossaria.plans import articles
from glossaria.plans.corpus import ORACLE as _CORPUS
from glossaria.plans.corpus import _POS, _SPACE, _TREEBANK, _WORDS, _peeled, _sql_reading, doc_frequency_vocab, grounded_answers, treebank
from glossaria.plans.lexicon import _EDGES, pointer_edges
from glossaria.operators.skew import spread
from glossaria.tables import table
from glossaria.workspace import materialise


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "freqfix_fw_headings2_ckpt")


def latest_wins_log(spark: SparkSession, sf: str) -> DataFrame:
    """The last answer per pass and article; lines without an answer are failures and were never results."""
    log = _answers(spark, sf).where("trim(g) != ''").withColumn("p", F.coalesce("p", F.lit("main")))
    log = log.withColumn("off", F.coalesce(F.col("off"), F.lit(-1)).cast("bigint"))
    return checkpoint.latest(log, ["p", "i"], "rec_id", ["g", "off"])


def stale_records(spark: SparkSession, sf: str) -> DataFrame:
    """Of the latest answers those written before their article was added: their input has changed since."""
    log = checkpoint.latest(_answers(spark, sf).where("g is not null"), ["i"], "rec_id", ["g", "logged_at"])
    e = table(spark, sf, "entry", "idx", "added_at")
    joined = log.join(e, log["i"] == e["idx"])
    return joined.groupBy((F.col("logged_at") >= F.col("added_at")).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


def resume_todo(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "entry", "idx", "removed_at").where("removed_at is null").select(F.col("idx").alias("i"))
    done = _answers(spark, sf).where("trim(g) != ''")
    return checkpoint.todo(wanted, done, ["i"])


def _judges(spark: SparkSession, sf: str) -> DataFrame:
    """Two judges' scores made from answers: by grounding in the article, and by length."""
    rows = grounded_answers(spark, sf)
    n = F.size(T.words(F.col("g")))
    a = F.round(F.col("raw") * 5).cast("int")
    b = F.when(n > 0, F.least(F.lit(5), F.greatest(F.lit(0), 6 - n))).cast("int")
    return rows.select("rec_id", "i", "p", a.alias("a"), b.alias("b"))


def _judges_sql() -> str:
    from glossaria.plans.corpus import _grounding_sql

    n = f"len({_WORDS.format(x='g')})"
    return f"""
        SELECT s.rec_id, k.i, s.p, CAST(round(raw * 5) AS INT) AS a, CASE WHEN {n} > 0 THEN least(5, greatest(0, 6 - {n})) END AS b
        FROM (SELECT rec_id, p, g, grounding AS raw FROM ({_grounding_sql()}) q) s JOIN (SELECT rec_id, i FROM freqfix_fw_headings2_ckpt) k ON s.rec_id = k.rec_id"""


def consensus_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return _judges(spark, sf).groupBy("p", judging.consensus(F.col("a"), F.col("b")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def verify_revert(spark: SparkSession, sf: str) -> DataFrame:
    """Each article's first and last judged answer: kept, reverted or flagged."""
    j = _judges(spark, sf)
    by = j.groupBy("i").agg(F.min_by("a", "rec_id").alias("before"), F.max_by("a", "rec_id").alias("after"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return by.select("i", "before", "after", judging.verify(F.col("before"), F.col("after")).alias("action"), judging.refine_accepted(F.col("before"), F.col("after")).alias("refined"))


def repair_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Articles to repair, by the least valid verdict of their answers, weighted by how often they were asked."""
    j = _judges(spark, sf).withColumn("worst", judging.worst_valid(F.col("a"), F.coalesce("b", F.lit(-1))))
    by = j.groupBy("i").agg(F.min("worst").alias("worst"), F.count(F.lit(1)).alias("n"))
    return by.where("worst <= 2")


def repair_accepted(spark: SparkSession, sf: str) -> DataFrame:
    j = _judges(spark, sf)
    last = Window.partitionBy("i").orderBy("rec_id")
    rows = j.withColumn("a0", F.lag("a").over(last)).withColumn("b0", F.lag("b").over(last)).where("a0 is not null")
    return rows.groupBy(judging.better(F.col("a"), F.col("a0"), F.col("b"), F.col("b0")).alias("better")).agg(F.count(F.lit(1)).alias("n"))


def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    n = _judges(spark, sf).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.col("a").alias("score"), "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def parse_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Judges' replies in several wordings, parsed back."""
    j = _judges(spark, sf).where("a is not null")
    a = F.col("a").cast("string")
    reply = (
        F.when(F.col("rec_id") % 5 == 0, F.concat(a, F.lit(" - fits")))
        .when(F.col("rec_id") % 5 == 1, F.concat(F.lit("Score: "), a))
        .when(F.col("rec_id") % 5 == 2, F.concat(F.lit("I give it "), a))
        .when(F.col("rec_id") % 5 == 3, F.concat(F.lit("The 3 words deserve the grade of "), a))
        .otherwise(F.concat(F.lit("between 2 and "), a))
    )
    return j.select("rec_id", reply.alias("reply")).select("rec_id", F.coalesce(T.parse_score(F.col("reply")), F.lit(-1)).alias("score"))


def eval_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Answers against the dictionary's definition of the same headword, by their words."""
    gold = table(spark, sf, "package_dictionary", "lemma", "definition").where("definition is not null").groupBy(N.letters(F.col("lemma")).alias("w")).agg(F.min("definition").alias("gold"))
    heads = table(spark, sf, "entry", "idx", "headword").select("idx", N.letters(F.col("headword")).alias("w"))
    rows = _answers(spark, sf).select("rec_id", "i", "g").where("g is not null").join(heads, F.col("i") == F.col("idx")).join(gold, "w")

    def bag(c: str):  # noqa: ANN202
        return F.filter(F.array_distinct(F.split(F.regexp_replace(F.lower(c), "[^a-z ]", ""), " ")), lambda x: x != "")

    verdict = judging.overlap_verdict(bag("g"), bag("gold"))
    return rows.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def issue_classes(spark: SparkSession, sf: str) -> DataFrame:
    n = _answers(spark, sf).groupBy(Q.issue_class(F.col("g")).alias("issue")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("issue", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def glosses_with_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lemma_map", "key", "headword", "gloss", "source", "freq").where("key is not null")
    distinct = rows.groupBy("key", "headword", "gloss", "source").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("freq"), F.lit(0)).alias("freq"))
    uses = doc_frequency_vocab(spark, sf).select(F.col("word").alias("_w"), F.col("n_entries").alias("uses"))
    bodies = table(spark, sf, "entry", "key", "body").groupBy("key").agg(F.min("body").alias("body")).withColumn("stems", Q.known_stems(F.col("body")))
    joined = distinct.join(bodies, "key", "left").join(uses, N.letters(F.col("headword")) == F.col("_w"), "left")
    return joined.withColumn("reasons", Q.reasons(F.col("headword"), F.col("gloss"), F.col("source"), F.col("body"), F.col("uses"), F.col("stems"))).drop("stems")


def defect_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Detector counts by distinct gloss, by line and by frequency."""
    found = glosses_with_reasons(spark, sf).select(F.explode("reasons").alias("reason"), "n", "freq")
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("glosses"), F.sum("n").alias("lines"), F.sum("freq").alias("freq"))


def ship_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Why a line is not shipped, the first reason that holds; a null gloss counts as unglossed."""
    rows = glosses_with_reasons(spark, sf)
    reason = judging.ship_reason(F.col("source"), F.col("gloss"), F.col("headword"), F.col("reasons"))
    judged = materialise(rows.select("key", "source", "n", "freq", reason.alias("reason")), "judged")
    # a pointer that took over a gloss the detectors reject is rejected with it
    entries = table(spark, sf, "entry", "idx", "key", "body")
    node = entries.select(F.col("idx").alias("node"), "key")
    targets = last_targets(materialise(pointer_edges(spark, sf), "edges"), entries.where("length(body) < 200").select(F.col("idx").alias("node")))
    rejected = node.join(judged.where("reason = 'detector'").select("key"), "key", "left_semi")
    inherits = inherit_rejection(rejected, targets).join(node, "node").select("key").distinct().withColumn("inherits", F.lit(True))
    taken = F.col("inherits") & (F.col("reason") == "shipped") & F.col("source").startswith("xref")
    judged = judged.join(inherits, "key", "left").withColumn("reason", F.when(taken, "inherits a rejected gloss").otherwise(F.col("reason")))
    return judged.groupBy("source", "reason").agg(F.sum("n").alias("lines"), F.sum("freq").alias("freq"))


def function_words(spark: SparkSession, sf: str) -> DataFrame:
    """``(idx)`` of function words, marked so or a bare pointer to one."""
    entries = table(spark, sf, "entry", "idx", "headword", "body")
    targets = last_targets(materialise(pointer_edges(spark, sf), "edges"), entries.where("length(body) < 200").select(F.col("idx").alias("node")))
    return find_function_words(entries, targets)


def repair_wanted(spark: SparkSession, sf: str, least: int = 2) -> DataFrame:
    """Articles whose last answer is to be repaired, with the reason: empty, objected to by a detector, or judged bad."""
    last = checkpoint.latest(_answers(spark, sf), ["i"], "rec_id", ["g"])
    rows = last.join(table(spark, sf, "entry", "idx", "headword", "body"), F.col("i") == F.col("idx")).withColumn("stems", Q.known_stems(F.col("body")))
    reasons = Q.reasons(F.col("headword"), F.col("g"), F.lit("model"), F.col("body"), F.lit(1), F.col("stems"))
    score = F.round(Q.grounding(F.coalesce("g", F.lit("")), F.col("stems")) * 5).cast("int")
    rows = rows.select("i", "g", reasons.alias("reasons"), score.alias("score"))
    return rows.select("i", judging.repair_reason(F.col("g"), F.col("reasons"), F.col("score"), least).alias("reason")).where("reason is not null")


def _first_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with the log's answers taken in stages: main, retry for those that decline, name for those that echo; then over pointers."""
    entries = table(spark, sf, "entry", "idx", "key", "headword", "body")
    log = _answers(spark, sf).select(F.col("i").alias("idx"), F.coalesce("p", F.lit("main")).alias("p"), F.col("g").alias("answer"), F.col("rec_id").alias("at"))
    rows = stages.classify(entries).join(stages.answers_by_pass(log, ["main", "retry", "name", "hard"]), "idx", "left")
    return stages.first_answers(rows, F.col("main"), F.col("retry"), name=F.col("name"))


def _take_over(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    short = table(spark, sf, "entry", "idx", "body").where("length(body) < 200").select(F.col("idx").alias("node"))
    return stages.inherited(rows, last_targets(materialise(pointer_edges(spark, sf), "edges"), short))


def stage_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Sources and glosses after the first stages, the taking over along pointers and the grounding mark."""
    rows = materialise(_first_stages(spark, sf).select("idx", "headword", "body", "gloss", "source"), "first-stages")
    rows = _take_over(spark, sf, rows)
    rows = stages.grounded(rows, Q.grounding(F.col("gloss"), Q.known_stems(F.col("body"))))
    return rows.select("idx", "gloss", "source")


def staged_glosses(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain: first answers, own words of names, suspects re-glossed, pointers, adaptation, grounding, cleaning, second screen, carry-over.

    The main answers of articles that were asked again later stand for the adapted ones, the repairs of an earlier build are the lemma map's last glosses of one feed.
    """
    uses = doc_frequency_vocab(spark, sf).select(F.col("word").alias("_w"), F.col("n_entries").alias("uses"))
    # names only, and written before anything is decided on it: the definition is a long expression
    named = table(spark, sf, "entry", "idx", "headword", "body").where(names.is_name(F.col("headword"))).select("idx", names.name_definition(articles.marked(), F.col("headword")).alias("own"))
    rows = _first_stages(spark, sf).join(materialise(named, "own-words"), "idx", "left")
    rows = stages.own_words(rows, F.col("own")).drop("own")
    rows = rows.withColumn("stems", Q.known_stems(F.col("body"))).join(uses, N.letters(F.col("headword")) == F.col("_w"), "left").drop("_w")
    rows = materialise(rows, "first-stages")
    rows = materialise(stages.reglossed(rows, F.col("hard"), F.col("uses"), "hard", F.col("stems")), "reglossed")
    rows = stages.adapted(_take_over(spark, sf, rows), F.col("main"))
    rows = stages.grounded(rows, Q.grounding(F.col("gloss"), F.col("stems")))
    rows = stages.finalised(rows, F.col("uses"))
    rows = materialise(stages.reglossed(rows, F.col("hard"), F.col("uses"), "hard2", F.col("stems")), "screened")
    rows = stages.finalised(rows, F.col("uses"))
    m = table(spark, sf, "lemma_map", "row_id", "key", "gloss", "source").where("source = 'handlist' and key is not null").groupBy("key").agg(F.max_by("gloss", "row_id").alias("gloss"))
    earlier = m.join(table(spark, sf, "entry", "idx", "key"), "key").select("idx", "gloss", F.lit("freqfix").alias("source"))
    return stages.carry_over(rows, earlier).select("idx", "gloss", "source")


def refinalised(spark: SparkSession, sf: str) -> DataFrame:
    """Lemma-map glosses finalised once more, without the echo rule: ``(gloss, new)`` of those that change."""
    rows = table(spark, sf, "lemma_map", "key", "headword", "gloss", "source").where("gloss is not null and key is not null").distinct()
    bodies = table(spark, sf, "entry", "key", "body").groupBy("key").agg(F.min("body").alias("body"))
    rows = rows.join(bodies, "key").withColumn("before", F.col("gloss"))
    done = stages.finalised(rows)
    return done.where("gloss != before").select("key", "headword", F.col("before").alias("gloss"), F.col("gloss").alias("new"), "source").distinct()


def clean_glosses(spark: SparkSession, sf: str) -> DataFrame:
    return T.enforce_cap(T.clean_glosses(_answers(spark, sf).select("rec_id", F.col("g").alias("gloss")), "gloss"), "gloss")


def synonym_packing(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lemma_map", "gloss").where("gloss is not null").distinct().select("gloss", T.pack_parts(F.col("gloss")).alias("packed"))


def ngram_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf).where("g is not null").select("rec_id", T.collapse_repeats(F.col("g")).alias("g"))


def window_offsets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", F.explode(T.windows(F.col("text"))).alias("w")).select("doc_id", F.col("w.at").cast("bigint").alias("at"), F.md5("w.part").alias("part"))


def best_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The window of a long text with most references, the first with five."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    scored = F.transform(T.windows(F.col("text")), lambda w: F.struct(w["at"].alias("at"), F.size(F.regexp_extract_all(w["part"], F.lit("Cf\\. [a-z]+"), F.lit(0))).alias("score")))
    return docs.select("doc_id", scored.alias("scored")).where("size(scored) > 0").select("doc_id", T.best_window(F.col("scored")).cast("bigint").alias("at"))


def budgeted_lines(spark: SparkSession, sf: str, budget: int = 900) -> DataFrame:
    """Lines of a text from its beginning while they fit a budget of characters; the first that doesn't ends it."""
    docs = spread(table(spark, sf, "documents", "doc_id", "text"), "doc_id")

    def add(acc: Column, line: Column) -> Column:
        chars = acc["chars"] + F.length(line)
        over = acc["over"] | (chars > budget)
        return F.struct(F.when(over, acc["lines"]).otherwise(acc["lines"] + 1).alias("lines"), F.when(over, acc["chars"]).otherwise(chars).alias("chars"), over.alias("over"))

    start = F.struct(F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("chars"), F.lit(False).alias("over"))
    kept = F.aggregate(F.split("text", "\n"), start, add)
    return docs.where("text is not null").select("doc_id", kept.alias("k")).select("doc_id", "k.lines", "k.chars").where("lines > 0")


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "lemma_map", "row_id", "key", "gloss", "loaded_at").where("key is not null")
    middle = F.lit("2024-01-01").cast("timestamp_ntz")
    last = lambda df: df.groupBy("key").agg(F.max_by("gloss", "row_id").alias("gloss"))
    at = F.col("loaded_at").cast("timestamp_ntz")
    return last(rows.where(at < middle)), last(rows.where(at >= middle))


def probe_diff(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _snapshots(spark, sf)
    return diffing.diff(before, after, "key", "gloss")


def metric_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, unglossed lines and distinct keys per feed, before and after the middle of the load, judged as metrics."""
    rows = table(spark, sf, "lemma_map", "source", "key", "gloss", "loaded_at").withColumn("new", F.col("loaded_at").cast("timestamp_ntz") >= F.lit("2024-01-01").cast("timestamp_ntz"))
    total = rows.groupBy("source").agg(*[F.count_if(F.col("new") == v).alias(f"n{k}") for k, v in enumerate((False, True))], *[F.count_if((F.col("new") == v) & F.col("gloss").isNull()).alias(f"bad{k}") for k, v in enumerate((False, True))])
    change = judging.metric_change(F.lit("count"), F.col("bad0"), F.col("bad1"), F.col("bad0") / F.col("n0"), F.col("bad1") / F.col("n1"))
    cover = judging.metric_change(F.lit("coverage"), 1 - F.col("bad0") / F.col("n0"), 1 - F.col("bad1") / F.col("n1"), F.lit(0.0), F.lit(0.0))
    return total.select("source", "bad0", "bad1", change.alias("unglossed"), cover.alias("coverage"))


def state_transition(spark: SparkSession, sf: str) -> DataFrame:
    """Gold readings against two builds' cells, one with a form's first reading only and one with all where there are several: how each state changes."""
    gold = treebank(spark, sf).select("form", tag_reading(F.col("postag")).alias("gold")).where("gold != ''").groupBy("form", "gold").agg(F.count(F.lit(1)).alias("n"))
    cells = gold.groupBy("form").agg(F.collect_list("gold").alias("r"))
    first = gold.groupBy("form").agg(F.min("gold").alias("cell0"))
    second = cells.where("size(r) > 1").select("form", merge_readings(F.col("r")).alias("cell1"))
    rows = gold.join(first, "form", "left").join(second, "form", "left")
    states = rows.select("n", cell_state(F.col("cell0"), F.col("gold")).alias("was"), cell_state(F.col("cell1"), F.col("gold")).alias("is"))
    return states.groupBy("was").pivot("is", ["absent", "blank", "exact", "compatible", "contradicted"]).agg(F.sum("n")).fillna(0)


def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.systematic_sample(table(spark, sf, "documents", "doc_id", "source").where("source is not null"), "source", "doc_id", 7, 3)


def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_sample(table(spark, sf, "entry", "idx", "key"), "idx", 100)


RULES = [("^prae", "pre", 1), ("ae", "e", 3), ("qu", "cu", 2), ("([aeiou])\\1", "$1", 0)]


def normal_rules_apply(spark: SparkSession, sf: str) -> DataFrame:
    forms = table(spark, sf, "package_dictionary", "lemma").distinct()
    return forms.select("lemma", T.apply_rules(F.col("lemma"), RULES).alias("spelling"))


def run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """What a run is identified by: a short hash of its instructions and of each pass's answers."""
    prompts = table(spark, sf, "prompt_text").select(F.col("pass_name").alias("p"), F.substring(F.sha2("body", 256), 1, 12).alias("prompt"))
    n = _answers(spark, sf).groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("i").alias("articles"), F.count_if(F.trim("g") == "").alias("blank"))
    return n.join(prompts, "p").select("p", "prompt", "n", "articles", "blank")


_MIDDLE = "TIMESTAMP '2024-01-01'"
_REASON_SQL = {
    "word-class": Q.WORD_CLASS,
    "form-note": Q.FORM_NOTE,
    "latin-chars": Q.LATIN_CHARS,
    "editorial-apparatus": Q.EDITORIAL,
}
_PACK = "list_filter(list_transform(string_split(regexp_replace({x}, ';', ',', 'g'), ','), lambda p: trim(p)), lambda p: p <> '')"
QUERIES = {
    "latest_wins_log": latest_wins_log,
    "stale_records": stale_records,
    "resume_todo": resume_todo,
    "consensus_verdict": consensus_verdict,
    "verify_revert": verify_revert,
    "repair_targets": repair_targets,
    "repair_accepted": repair_accepted,
    "score_distribution": score_distribution,
    "parse_scores": parse_scores,
    "eval_verdict": eval_verdict,
    "issue_classes": issue_classes,
    "defect_reasons": defect_reasons,
    "ship_filter": ship_filter,
    "function_words": function_words,
    "repair_wanted": lambda spark, sf: repair_wanted(spark, sf),
    "stage_marks": stage_marks,
    "staged_glosses": staged_glosses,
    "refinalised": refinalised,
    "clean_glosses": clean_glosses,
    "synonym_packing": synonym_packing,
    "ngram_collapse": ngram_collapse,
    "window_offsets": window_offsets,
    "best_windows": best_windows,
    "budgeted_lines": budgeted_lines,
    "probe_diff": probe_diff,
    "metric_regression": metric_regression,
    "state_transition": state_transition,
    "systematic_sample": systematic_sample,
    "hash_sample": hash_sample,
    "normal_rules_apply": normal_rules_apply,
    "run_metadata": run_metadata,
}
_J = _judges_sql()
_GREEK = "[Ͱ-Ͽ]"
_ISSUE = rf"""CASE WHEN t = '' THEN 'empty' WHEN regexp_matches(t, '(?i)^error') THEN 'error' WHEN regexp_matches(t, '(?i)^(xref|v\.|vide|cf\.|see) ?') THEN 'reference'
    WHEN regexp_matches(t, '(?i)\b(because|therefore|the user|the entry|i think)\b') THEN 'reasoning' WHEN regexp_matches(t, '{_GREEK}') THEN 'greek'
    WHEN len({_WORDS.format(x='t')}) > 8 THEN 'too long' ELSE 'ok' END"""
_COLLAPSE = " ".join(
    f"WHEN len(list_filter(range(1, len(w) - {2 * n} + 2), lambda i: w[i:i + {n - 1}] = w[i + {n}:i + {2 * n - 1}])) > 0 THEN array_to_string(w[1:list_filter(range(1, len(w) - {2 * n} + 2), lambda i: w[i:i + {n - 1}] = w[i + {n}:i + {2 * n - 1}])[1] + {n - 1}], ' ')"
    for n in range(1, 9)
)
_VOCAB = _CORPUS["doc_frequency_vocab"]
_STOPS = "[" + ", ".join(f"'{w}'" for w in Q.STOP_WORDS) + "]"
_STEMMED = f"list_transform(list_filter(string_split(regexp_replace(TEXT, '[^a-z ]', ' ', 'g'), ' '), lambda w: length(w) > 2 AND NOT list_contains({_STOPS}, w)), lambda w: substr(w, 1, greatest(4, length(w) - 2)))"
_ECHO = "(len(PARTS) > 0 AND h <> '' AND len(list_filter(PARTS, lambda p: NOT (p.l = h OR list_contains(['ae','i','is','us','um','a','onis','ei','n','m','f','entis','atis','inis'], lower(p.t))))) = 0)"
_PARTS_OF = "list_transform(list_filter(list_transform(string_split(regexp_replace(GLOSS, ';', ',', 'g'), ','), lambda p: trim(p)), lambda p: p <> ''), lambda p: {'t': p, 'l': " + N.sql_letters("p") + "})"
_FOCUSED = _SPACE.format(x=f"split_part(body, ',', 1) || ': ' || {_peeled('body')}")
_AGAINST = rf"\b\p{{Lu}}\p{{L}}{{1,6}}\.\s*(?:{'|'.join(Q.AGAINST)})\.?\s+\p{{Lu}}\p{{L}}*\.?|[—-]\s*(?i:Adv)\.|(?i:\bby conj)\."
# word boundaries spelled out: those of this SQL know ASCII letters only
_MARKED = r"(?i)(?:^|[^\p{L}\p{M}\p{N}_])(?:" + "|".join(Q.FUNCTION_MARKS) + r")(?:[^\p{L}\p{M}\p{N}_]|$)"
_LISTED = {n: "[" + ", ".join(f"'{w}'" for w in v) + "]" for n, v in (("func", Q.FUNCTION_WORDS), ("pron", Q.PRONOUNS), ("alone", Q.NEVER_ALONE), ("last", Q.NEVER_LAST))}
_ALL = "len(list_filter({x}, lambda w: NOT list_contains({y}, w))) = 0"
_OWN_MARK = rf"""
    len(list_filter(range(2, 6), lambda i: regexp_matches(coalesce(hp[i], ''), '(?i)^\s*(?:[a-z]\.\s*)?(?:{'|'.join(Q.OWN_MARKS)})\b') AND length(hp[1]) <= 40
        AND len(list_filter(range(2, i), lambda j: length(hp[j]) > 30)) = 0)) > 0"""
_REASONED = rf"""
    d AS (SELECT key, headword, gloss, source, count(*) AS n, CAST(coalesce(sum(freq), 0) AS BIGINT) AS freq FROM lemma_map WHERE key IS NOT NULL GROUP BY ALL),
    b AS (SELECT key, min(body) AS body FROM entry GROUP BY key),
    bf AS (SELECT key, body, focused, substr(regexp_replace(substr(focused, 1, 300), '{_AGAINST}', ' ', 'g'), 1, 80) AS line, string_split(substr(focused, 1, 120), ',') AS hp, {_STEMMED.replace('TEXT', N.sql_strip_accents('body'))} AS bs,
                  {N.sql_letters(f"regexp_extract(substr(body, 1, 160), '{Q.ETYMON}', 1) || regexp_extract(substr(body, 1, 160), '{Q.ETYMON}', 2)")} AS etymon FROM (SELECT key, body, {_FOCUSED} AS focused FROM b) x),
    v AS ({_VOCAB}),
    j AS (SELECT d.*, trim(coalesce(gloss, '')) AS t, regexp_replace(source, '[~?]+$', '') AS origin, {N.sql_letters('headword')} AS h, hp, bs, coalesce(etymon, '') AS etymon, coalesce(regexp_matches(line, '{_MARKED}'), false) AS isf
          FROM d LEFT JOIN bf ON bf.key = d.key),
    k AS (SELECT j.*, coalesce(v.n_entries, 0) AS uses, {_PARTS_OF.replace('GLOSS', 't')} AS parts, list_transform({_WORDS.format(x='t')}, lambda w: lower(regexp_replace(w, '^[,;.:]+|[,;.:]+$', '', 'g'))) AS w,
                 {_STEMMED.replace('TEXT', N.sql_strip_accents('t'))} AS gs, {N.sql_letters('t')} AS tl, regexp_matches(translate(t, chr(8209), '-'), '{Q.FORM_NOTE}') AS noted FROM j LEFT JOIN v ON v.word = j.h),
    reasoned AS (SELECT key, headword, gloss, source, n, freq, h, tl, t, CASE WHEN t = '' THEN [] ELSE list_filter([
        CASE WHEN origin IN ('model', 'repaired', 'named') AND NOT isf AND len(gs) > 0 AND len(list_filter(gs, lambda x: list_contains(coalesce(bs, []), x))) = 0 THEN 'ungrounded' END,
        CASE WHEN regexp_matches(t, '{Q.WORD_CLASS}') OR regexp_matches(t, '{Q.LETTER}') OR (NOT noted AND coalesce({_OWN_MARK}, false) AND (regexp_matches(t, '(?i)\b(?:{'|'.join(Q.CLASS_WORDS)})\b') OR regexp_matches(t, '{Q.FRAME}'))) THEN 'word-class' END,
        CASE WHEN noted THEN 'form-note' END,
        CASE WHEN regexp_matches(t, '{Q.LATIN_CHARS}') THEN 'latin-chars' END,
        CASE WHEN regexp_matches(t, '{Q.EDITORIAL}') THEN 'editorial-apparatus' END,
        CASE WHEN {_ECHO.replace('PARTS', 'parts')} THEN 'bare-echo' END,
        CASE WHEN len(w) > 0 AND CASE WHEN {_ALL.format(x='w', y=_LISTED['func'])} AND NOT isf THEN len(w) > 1 AND NOT {_ALL.format(x='w', y=_LISTED['pron'])} OR list_contains({_LISTED['alone']}, w[1]) OR coalesce(origin, '') <> 'xref-resolved' AND NOT list_contains({_LISTED['pron']}, w[1])
             ELSE len(w) = 3 AND w[1] = 'of' AND w[2] = 'or' OR len(w) > 1 AND list_contains({_LISTED['last']}, w[len(w)]) END THEN 'fragment' END,
        CASE WHEN len(parts) > 1 AND h <> '' AND NOT regexp_matches(headword, '^[-^]*\p{{Lu}}') AND parts[1].l = h AND uses < 1 THEN 'head-echo' END,
        CASE WHEN len(w) = 1 AND etymon <> '' AND etymon = tl AND etymon <> h THEN 'etymology-leak' END,
        CASE WHEN origin = 'xref-resolved' AND regexp_matches(regexp_replace(headword, '\.+$', ''), '(e|iter|ter)$') AND regexp_matches(t, '^to\s') THEN 'adv-inherits-verb' END], lambda r: r IS NOT NULL) END AS reasons FROM k)"""
ORACLE = {
    "defect_reasons": f"WITH {_REASONED} SELECT reason, count(*) AS glosses, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(freq) AS BIGINT) AS freq FROM (SELECT unnest(reasons) AS reason, n, freq FROM reasoned) u GROUP BY reason",
    "ship_filter": f"""
        WITH RECURSIVE {_REASONED}, {_EDGES}, short AS (SELECT idx AS node FROM entry WHERE length(body) < 200),
        walk AS (SELECT src, dst AS node_at, [src, dst] AS path, 1 AS hops FROM edges WHERE src IN (SELECT node FROM short)
                 UNION ALL SELECT w.src, e.dst, list_append(w.path, e.dst), w.hops + 1 FROM walk w JOIN edges e ON w.node_at = e.src WHERE w.hops < 4 AND w.node_at IN (SELECT node FROM short) AND NOT list_contains(w.path, e.dst)),
        target AS (SELECT src, arg_max(node_at, hops) AS dst FROM walk GROUP BY src),
        judged AS (SELECT key, source, n, freq, CASE WHEN t = '' THEN 'no gloss' WHEN list_contains(reasons, 'ungrounded') THEN 'ungrounded' WHEN list_has_any(reasons, ['bare-echo', 'word-class', 'form-note', 'editorial-apparatus', 'fragment', 'etymology-leak']) THEN 'detector' WHEN tl = h THEN 'echo' ELSE 'shipped' END AS reason FROM reasoned),
        rejected AS (SELECT DISTINCT idx FROM entry WHERE key IN (SELECT key FROM judged WHERE reason = 'detector')),
        taken AS (SELECT DISTINCT e.key FROM target t JOIN entry e ON e.idx = t.src WHERE t.dst IN (SELECT idx FROM rejected))
        SELECT source, CASE WHEN reason = 'shipped' AND source LIKE 'xref%' AND key IN (SELECT key FROM taken) THEN 'inherits a rejected gloss' ELSE reason END AS reason, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(freq) AS BIGINT) AS freq FROM judged GROUP BY ALL""",
    "function_words": f"""
        WITH RECURSIVE {_EDGES}, short AS (SELECT idx AS node FROM entry WHERE length(body) < 200),
        walk AS (SELECT src, dst AS node_at, [src, dst] AS path, 1 AS hops FROM edges WHERE src IN (SELECT node FROM short)
                 UNION ALL SELECT w.src, e.dst, list_append(w.path, e.dst), w.hops + 1 FROM walk w JOIN edges e ON w.node_at = e.src WHERE w.hops < 4 AND w.node_at IN (SELECT node FROM short) AND NOT list_contains(w.path, e.dst)),
        target AS (SELECT src, arg_max(node_at, hops) AS dst FROM walk GROUP BY src),
        f AS (SELECT idx, headword, body AS whole, substr(regexp_replace(substr({_FOCUSED}, 1, 300), '{_AGAINST}', ' ', 'g'), 1, 80) AS line, substr(regexp_replace(body, '\\([^()]*\\)', ' ', 'g'), 1, 60) AS body FROM entry),
        own AS (SELECT idx FROM f WHERE coalesce(CASE {_POS} WHEN 'prep' THEN 'praep' ELSE {_POS} END, '') IN ('conj', 'praep', 'adv', 'pron', 'interj', 'num')
                OR regexp_matches(line, '{_MARKED}') AND length({N.sql_letters('headword')}) > 1)
        SELECT idx FROM own UNION SELECT f.idx FROM f JOIN target t ON t.src = f.idx WHERE length(whole) < 60 AND strpos(whole, '=') = 0 AND NOT rtrim(headword) LIKE '%-' AND t.dst IN (SELECT idx FROM own)""",
    "stage_marks": f"""
        WITH RECURSIVE {_EDGES}, short AS (SELECT idx AS node FROM entry WHERE length(body) < 200),
        walk AS (SELECT src, dst AS node_at, [src, dst] AS path, 1 AS hops FROM edges WHERE src IN (SELECT node FROM short)
                 UNION ALL SELECT w.src, e.dst, list_append(w.path, e.dst), w.hops + 1 FROM walk w JOIN edges e ON w.node_at = e.src WHERE w.hops < 4 AND w.node_at IN (SELECT node FROM short) AND NOT list_contains(w.path, e.dst)),
        target AS (SELECT src, arg_max(node_at, hops) AS dst FROM walk GROUP BY src),
        a AS (SELECT i AS idx, arg_max(g, rec_id) FILTER (coalesce(p, 'main') = 'main') AS m, arg_max(g, rec_id) FILTER (p = 'retry') AS r, arg_max(g, rec_id) FILTER (p = 'name') AS n FROM freqfix_fw_headings2_ckpt WHERE trim(g) <> '' GROUP BY i),
        s0 AS (SELECT e.idx, headword, body, {N.sql_letters("headword")} AS h, m, r, n,
                      length(body) <= 160 AND NOT regexp_matches(body, '(?i)\\bv\\.\\s+(freq|dep|a|n|impers|inch|intens|defect)\\b') AND regexp_matches(body, '(?i)[,;]\\s*(v\\.?|vide)\\s+([0-9]+\\.?\\s*)?[A-Za-zÀ-ɏ''-]+\\s*\\.?\\s*$') AS pointer
               FROM entry e LEFT JOIN a ON a.idx = e.idx),
        s1 AS (SELECT *, CASE WHEN pointer THEN 'xref' ELSE 'model' END AS s, CASE WHEN pointer THEN '' ELSE coalesce(m, '') END AS g FROM s0),
        s2 AS (SELECT * REPLACE (CASE WHEN s = 'model' AND upper(trim(g)) IN ('XREF', 'NONE', '') AND r IS NOT NULL THEN 'repaired' ELSE s END AS s, CASE WHEN s = 'model' AND upper(trim(g)) IN ('XREF', 'NONE', '') AND r IS NOT NULL THEN r ELSE g END AS g) FROM s1),
        p2 AS (SELECT *, {_PARTS_OF.replace('GLOSS', 'g')} AS gp, {_PARTS_OF.replace('GLOSS', "coalesce(n, '')")} AS np FROM s2),
        e2 AS (SELECT *, s IN ('model', 'repaired') AND {_ECHO.replace('PARTS', 'gp')} AND n IS NOT NULL AND upper(trim(n)) NOT IN ('XREF', 'NONE') AND NOT {_ECHO.replace('PARTS', 'np')} AS named FROM p2),
        s3 AS (SELECT idx, body, CASE WHEN named THEN 'named' ELSE s END AS s, CASE WHEN named THEN n ELSE g END AS g FROM e2),
        s4 AS (SELECT x.idx, x.body, CASE WHEN NOT asks THEN x.s WHEN coalesce(trim(y.g), '') <> '' THEN 'xref-resolved' ELSE 'no-gloss' END AS s, CASE WHEN NOT asks THEN x.g WHEN coalesce(trim(y.g), '') <> '' THEN y.g ELSE '' END AS g
               FROM (SELECT *, s = 'xref' OR upper(trim(g)) IN ('XREF', 'NONE') AS asks FROM s3) x LEFT JOIN target t ON t.src = x.idx LEFT JOIN s3 y ON y.idx = t.dst),
        stemmed AS (SELECT *, {_STEMMED.replace('TEXT', N.sql_strip_accents('g'))} AS gs, {_STEMMED.replace('TEXT', N.sql_strip_accents('body'))} AS bs FROM s4)
        SELECT idx, g AS gloss, s || CASE WHEN s IN ('model', 'repaired', 'named') AND trim(g) <> '' AND len(gs) > 0 AND len(list_filter(gs, lambda w: list_contains(bs, w))) = 0 THEN '?' ELSE '' END AS source FROM stemmed""",
    "latest_wins_log": "SELECT p, i, rec_id, g, off FROM (SELECT coalesce(p, 'main') AS p, i, rec_id, g, CAST(coalesce(off, -1) AS BIGINT) AS off, row_number() OVER (PARTITION BY coalesce(p, 'main'), i ORDER BY rec_id DESC) AS r FROM freqfix_fw_headings2_ckpt WHERE trim(g) <> '') x WHERE r = 1",
    "stale_records": "SELECT logged_at >= added_at AS valid, count(*) AS n FROM (SELECT i, arg_max(logged_at, rec_id) AS logged_at FROM freqfix_fw_headings2_ckpt WHERE g IS NOT NULL GROUP BY i) l JOIN entry e ON l.i = e.idx GROUP BY ALL",
    "resume_todo": "SELECT idx AS i FROM entry WHERE removed_at IS NULL AND idx NOT IN (SELECT i FROM freqfix_fw_headings2_ckpt WHERE trim(g) <> '' AND i IS NOT NULL)",
    "consensus_verdict": f"SELECT p, CASE WHEN b IS NULL THEN 'unjudged' WHEN a <= 2 AND b <= 2 THEN 'both-bad' WHEN abs(a - b) >= 3 THEN 'disagree' WHEN b >= 4 THEN 'judgeB-ok' ELSE 'weak' END AS verdict, count(*) AS n FROM ({_J}) j GROUP BY ALL",
    "verify_revert": f"""
        SELECT i, before, after, CASE WHEN after >= 4 THEN 'keep' WHEN after < before THEN 'revert' ELSE 'flag' END AS action, after > before AS refined
        FROM (SELECT i, arg_min(a, rec_id) AS before, arg_max(a, rec_id) AS after, count(*) AS n FROM ({_J}) j GROUP BY i) x WHERE n > 1""",
    "repair_targets": f"SELECT i, min(CASE WHEN b IS NULL THEN a ELSE least(a, b) END) AS worst, count(*) AS n FROM ({_J}) j GROUP BY i HAVING min(CASE WHEN b IS NULL THEN a ELSE least(a, b) END) <= 2",
    "repair_accepted": f"SELECT coalesce(a >= 4 AND a > a0 AND b >= b0, false) AS better, count(*) AS n FROM (SELECT *, lag(a) OVER w AS a0, lag(b) OVER w AS b0 FROM ({_J}) j WINDOW w AS (PARTITION BY i ORDER BY rec_id)) x WHERE a0 IS NOT NULL GROUP BY ALL",
    "score_distribution": f"SELECT a AS score, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ({_J}) j GROUP BY a",
    "parse_scores": f"SELECT rec_id, CASE WHEN rec_id % 5 = 4 THEN -1 ELSE a END AS score FROM ({_J}) j WHERE a IS NOT NULL",
    "eval_verdict": rf"""
        WITH gold AS (SELECT {N.sql_letters('lemma')} AS w, min(definition) AS gold FROM package_dictionary WHERE definition IS NOT NULL GROUP BY ALL),
        bags AS (SELECT list_filter(list_distinct(string_split(regexp_replace(lower(g), '[^a-z ]', '', 'g'), ' ')), lambda x: x <> '') AS a,
                        list_filter(list_distinct(string_split(regexp_replace(lower(gold), '[^a-z ]', '', 'g'), ' ')), lambda x: x <> '') AS b
                 FROM freqfix_fw_headings2_ckpt k JOIN entry e ON k.i = e.idx JOIN gold ON gold.w = {N.sql_letters('headword')} WHERE g IS NOT NULL),
        s AS (SELECT len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS c FROM bags)
        SELECT CASE WHEN na = 0 THEN 'EMPTY' WHEN (c = na OR c = nb) AND c > 0 THEN 'PASS' WHEN c / (na + nb - c) >= 0.5 THEN 'REVIEW' ELSE 'FAIL' END AS verdict, count(*) AS n FROM s GROUP BY ALL""",
    "issue_classes": f"SELECT {_ISSUE} AS issue, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT trim(coalesce(g, '')) AS t FROM freqfix_fw_headings2_ckpt) x GROUP BY ALL",
    "synonym_packing": f"""
        SELECT gloss, CASE WHEN len(p) > 1 THEN array_to_string(p[1:len(list_filter(range(1, len(p) + 1), lambda i: i = 1 OR list_sum(list_transform(p[1:i], lambda x: len({_WORDS.format(x='x')}))) <= 4))], ', ') ELSE gloss END AS packed
        FROM (SELECT gloss, {_PACK.format(x='gloss')} AS p FROM (SELECT DISTINCT gloss FROM lemma_map WHERE gloss IS NOT NULL) d) x""",
    "ngram_collapse": f"SELECT rec_id, CASE {_COLLAPSE} ELSE g END AS g FROM (SELECT rec_id, g, {_WORDS.format(x='g')} AS w FROM freqfix_fw_headings2_ckpt WHERE g IS NOT NULL) x",
    "window_offsets": "SELECT doc_id, CAST(k * 800 AS BIGINT) AS at, md5(substr(text, CAST(k * 800 + 1 AS BIGINT), 800)) AS part FROM documents, (SELECT unnest([0, 2, 4, 6]) AS k) o WHERE length(substr(text, CAST(k * 800 + 1 AS BIGINT), 800)) >= 60",
    "best_windows": r"""
        WITH w AS (SELECT doc_id, CAST(k * 800 AS BIGINT) AS pos, len(regexp_extract_all(substr(text, CAST(k * 800 + 1 AS BIGINT), 800), 'Cf\. [a-z]+')) AS score
                   FROM documents, (SELECT unnest([0, 2, 4, 6]) AS k) o WHERE length(substr(text, CAST(k * 800 + 1 AS BIGINT), 800)) >= 60)
        SELECT doc_id, coalesce(min(CASE WHEN score >= 5 THEN pos END), arg_max(pos, (score, -pos))) AS at FROM w GROUP BY doc_id""",
    "budgeted_lines": """
        SELECT doc_id, count(*) AS lines, CAST(max(so_far) AS BIGINT) AS chars FROM (
            SELECT doc_id, sum(length(l[pos])) OVER (PARTITION BY doc_id ORDER BY pos) AS so_far FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents) p) s
        WHERE so_far <= 900 GROUP BY doc_id""",
    "probe_diff": f"""
        WITH b AS (SELECT key, arg_max_null(gloss, row_id) AS gloss FROM lemma_map WHERE key IS NOT NULL AND loaded_at < {_MIDDLE} GROUP BY key),
        a AS (SELECT key, arg_max_null(gloss, row_id) AS gloss FROM lemma_map WHERE key IS NOT NULL AND loaded_at >= {_MIDDLE} GROUP BY key)
        SELECT coalesce(b.key, a.key) AS key, b.gloss AS before, a.gloss AS after, CASE WHEN b.key IS NULL THEN 'added' WHEN a.key IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM b FULL JOIN a ON b.key = a.key WHERE b.key IS NULL OR a.key IS NULL OR b.gloss IS DISTINCT FROM a.gloss""",
    "metric_regression": f"""
        SELECT source, bad0, bad1, CASE WHEN bad1 > bad0 AND round(bad1 / n1, 4) > round(bad0 / n0, 4) THEN 'worse' WHEN bad1 < bad0 THEN 'better' WHEN bad1 > bad0 THEN 'scale' ELSE 'same' END AS unglossed,
               CASE WHEN 1 - bad1 / n1 < 1 - bad0 / n0 THEN 'worse' WHEN 1 - bad1 / n1 > 1 - bad0 / n0 THEN 'better' ELSE 'same' END AS coverage
        FROM (SELECT source, count(*) FILTER (loaded_at < {_MIDDLE}) AS n0, count(*) FILTER (loaded_at >= {_MIDDLE}) AS n1,
                     count(*) FILTER (loaded_at < {_MIDDLE} AND gloss IS NULL) AS bad0, count(*) FILTER (loaded_at >= {_MIDDLE} AND gloss IS NULL) AS bad1 FROM lemma_map GROUP BY source) m""",
    "systematic_sample": "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM documents WHERE source IS NOT NULL) x WHERE r % 7 = 3",
    "hash_sample": "SELECT idx, key FROM entry ORDER BY md5(idx || '#1'), idx LIMIT 100",
    "normal_rules_apply": "SELECT DISTINCT lemma, replace(replace(replace(replace(replace(regexp_replace(replace(replace(lemma, 'ae', 'e'), 'qu', 'cu'), '^prae', 'pre'), 'aa', 'a'), 'ee', 'e'), 'ii', 'i'), 'oo', 'o'), 'uu', 'u') AS spelling FROM package_dictionary",
    "run_metadata": "SELECT k.p, prompt, n, articles, blank FROM (SELECT p, count(*) AS n, count(DISTINCT i) AS articles, count(*) FILTER (trim(g) = '') AS blank FROM freqfix_fw_headings2_ckpt GROUP BY p) k JOIN (SELECT pass_name AS p, substr(sha256(body), 1, 12) AS prompt FROM prompt_text) t ON k.p = t.p",
    "state_transition": f"""
        WITH gold AS (SELECT form, gold, count(*) AS n FROM (SELECT form, {_sql_reading('postag')} AS gold FROM ({_TREEBANK}) t) g WHERE gold <> '' GROUP BY ALL),
        c0 AS (SELECT form, min(gold) AS cell0, count(*) AS k FROM gold GROUP BY form),
        slots AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{v}')" for s, vs in __import__("glossaria.functions.readings", fromlist=["SLOTS"]).SLOTS.items() if s != "clitic" for v in vs)}) v(slot, value)),
        told AS (SELECT form, gold, slot, value FROM (SELECT form, gold, unnest(string_split(gold, ' ')) AS value FROM gold) u JOIN slots USING (value)),
        clash AS (SELECT DISTINCT a.form, a.gold AS ours, b.gold FROM told a JOIN told b ON a.form = b.form AND a.slot = b.slot AND a.value <> b.value AND NOT (a.slot = 'gender' AND (a.value = 'c' OR b.value = 'c'))
                  UNION SELECT x.form, x.gold, y.gold FROM gold x JOIN gold y ON x.form = y.form
                  WHERE (EXISTS (SELECT 1 FROM told t WHERE t.form = x.form AND t.gold = x.gold AND t.slot = 'category')) <> (EXISTS (SELECT 1 FROM told t WHERE t.form = y.form AND t.gold = y.gold AND t.slot = 'category'))),
        kept AS (SELECT a.form, a.gold AS ours FROM gold a WHERE NOT EXISTS (SELECT 1 FROM gold b WHERE b.form = a.form AND b.gold <> a.gold AND len(list_filter(string_split(a.gold, ' '), lambda t: NOT list_contains(string_split(b.gold, ' '), t))) = 0)),
        s AS (SELECT g.n, CASE WHEN cell0 = g.gold THEN 'exact' WHEN NOT EXISTS (SELECT 1 FROM clash c WHERE c.form = g.form AND c.ours = cell0 AND c.gold = g.gold) THEN 'compatible' ELSE 'contradicted' END AS was,
              CASE WHEN k < 2 THEN 'absent' WHEN EXISTS (SELECT 1 FROM kept p WHERE p.form = g.form AND p.ours = g.gold) THEN 'exact'
                   WHEN EXISTS (SELECT 1 FROM kept p WHERE p.form = g.form AND NOT EXISTS (SELECT 1 FROM clash c WHERE c.form = g.form AND c.ours = p.ours AND c.gold = g.gold)) THEN 'compatible' ELSE 'contradicted' END AS now
              FROM gold g JOIN c0 ON g.form = c0.form)
        SELECT was, {", ".join(f"CAST(sum(CASE WHEN now = '{x}' THEN n ELSE 0 END) AS BIGINT) AS {x}" for x in ("absent", "blank", "exact", "compatible", "contradicted"))} FROM s GROUP BY was""",
}
