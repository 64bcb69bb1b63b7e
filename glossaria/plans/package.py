"""Queries of what a package is made of: senses, leaders, joined forms, checks against gold, and the texts shown to judges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.functions import text as T
from glossaria.functions.readings import SLOTS, slot_of, tag_reading
from glossaria.operators import package as K
from glossaria.operators import paradigms as P
from glossaria.operators.pointers import last_targets
from glossaria.operators.ranking import frequency_weight
from glossaria.plans.corpus import _COUNTS, _HEAD, _KNOWN, _POS, _SPACE, _TREEBANK, TOKEN, _peeled, _sql_reading, form_counts, known_forms, treebank
from glossaria.plans.judgements import _J, _judges, glosses_with_reasons
from glossaria.plans.lexicon import _CANDIDATES, _EDGES, _STEM, confidence_blend, pointer_edges
from glossaria.plans.paradigms import _FORMS
from glossaria.operators.skew import spread
from glossaria.tables import table
from glossaria.workspace import materialise


def _senses(spark: SparkSession, sf: str) -> DataFrame:
    """Each article with its last gloss, whether that is shippable, and how often treebank feeds name it."""
    e = table(spark, sf, "entry", "idx", "key", "headword", "body")
    m = table(spark, sf, "lemma_map", "row_id", "key", "gloss", "source").where("key is not null")
    last = m.groupBy("key").agg(F.max_by(F.struct("gloss", "source"), "row_id").alias("g"), F.count_if(F.col("source").isin("treebank", "tb_export")).alias("seen")).select("key", "g.*", "seen")
    rows = e.join(last, "key").where("trim(gloss) != ''")
    mark = T.pos_marker(F.col("body"))
    return rows.select(
        N.split_number(F.col("key"))[0].alias("lemma"), "idx", "gloss", F.col("source").startswith("web").alias("pointer"), F.length("body").alias("size"), F.lit(None).cast("int").alias("score"), "seen",
        (F.length("gloss") < 14).alias("bad"), F.coalesce(mark.isin("adv", "conj", "praep", "pron", "interj", "num"), F.col("idx") % 3 == 0).alias("is_function"),
    )


def primary_senses(spark: SparkSession, sf: str) -> DataFrame:
    """Primary and minor senses of each lemma; short glosses stand for excluded ones, one feed for pointers, so that all branches are met."""
    return K.primary_senses(_senses(spark, sf)).select("lemma", "idx", F.col("n").cast("bigint").alias("n"))


def lead_by_majority(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "lemma_map", "form", "key", "lemma", "source").where("key is not null and lemma is not null").select(N.fold(F.col("form")).alias("form"), "key", "lemma", "source").where("form != ''")
    m = materialise(m, "lines")
    bare = N.split_number(F.col("key"))[0]
    cands = m.groupBy("form", F.col("key").alias("lemma")).agg(F.count(F.lit(1)).alias("k")).select("form", "lemma", N.split_number(F.col("lemma"))[0].alias("bare"), F.least(F.lit(1.0), F.col("k") / 10).alias("conf"))
    votes = m.groupBy("form", F.col("lemma").alias("bare")).agg(F.count(F.lit(1)).alias("n"))
    targets = m.select(bare.alias("bare"), F.col("lemma").alias("target")).where("bare != target").distinct()
    return K.lead_by_majority(cands, votes, targets).select("form", "lemma", F.round("conf", 6).alias("conf"))


def enclitic_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Joined forms that ship: host forms with -que and -ve, the enclitic's own row, orphans dropped after the cap; counted by enclitic and kind."""
    host, name = T.split_enclitic(F.col("form"))
    base = materialise(confidence_blend(spark, sf).select("form", "lemma", "conf", "ord"), "base")
    heads = table(spark, sf, "entry", "headword").select(N.fold(F.col("headword")).alias("form")).distinct()
    whole = base.where(name == "")
    joined = whole.select(F.explode(F.array(F.lit("que"), F.lit("ve"))).alias("enc"), F.col("form").alias("host"), "lemma", (F.col("conf") * 0.75).alias("conf"), "ord")
    joined = joined.withColumn("form", F.translate(F.concat("host", "enc"), "jv", "iu")).where((host == F.col("host")) & (name == F.col("enc"))).join(heads, "form", "left_anti")
    known = base.select("form", "lemma", "conf", "ord", F.lit(None).cast("string").alias("host"))
    new = joined.join(base.select("form", "lemma"), ["form", "lemma"], "left_anti").select("form", "lemma", "conf", "ord", "host")
    own = joined.groupBy("form").agg(F.lit(0.30).alias("conf"), F.min("ord").alias("ord")).select("form", F.lit(None).cast("string").alias("lemma"), "conf", "ord", F.lit(None).cast("string").alias("host"))
    rows = known.unionByName(new).unionByName(own).join(heads.withColumn("is_head", F.lit(True)), "form", "left").fillna(False, ["is_head"])
    kept = K.drop_orphaned(rows)
    kind = F.when(F.col("lemma").isNull(), "enclitic").when(F.col("host").isNotNull(), "joined").otherwise("word")
    return kept.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("form").alias("forms"))


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    rows = treebank(spark, sf).select(N.fold(F.col("form")).alias("form"), N.fold(N.split_number(F.col("lemma"))[0]).alias("lemma"), tag_reading(F.col("postag")).alias("reading"))
    return rows.where("form != '' and reading != ''").groupBy("form", "lemma", "reading").agg(F.count(F.lit(1)).alias("n"))


def _package(spark: SparkSession, sf: str) -> DataFrame:
    """Forms of the regular classes under their headwords; of articles with equal headwords the first counts."""
    e = table(spark, sf, "entry", "idx", "headword", "body")
    heads = e.select("idx", N.fold(F.col("headword")).alias("lemma"))
    made = P.expand(e).select("idx", "form", "cell").join(heads, "idx")
    return made.groupBy("form", "lemma").agg(F.min_by("cell", "idx").alias("cell"))


def _judged_gold(spark: SparkSession, sf: str) -> DataFrame:
    # treebank forms are attested by their documents alone; the lemma is asked for as the package's own where it has the form
    gold, package = _gold(spark, sf), materialise(_package(spark, sf), "package")
    near = package.groupBy("form").agg(F.min("lemma").alias("near"))
    gold = gold.join(near, "form", "left").withColumn("lemma", F.when(F.length("reading") % 3 > 0, F.coalesce("near", "lemma")).otherwise(F.col("lemma"))).drop("near")
    return K.against_gold(gold.groupBy("form", "lemma", "reading").agg(F.sum("n").alias("n")), package)


def gold_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return _judged_gold(spark, sf).groupBy("outcome").agg(F.count(F.lit(1)).alias("triples"), F.sum("n").alias("tokens"))


def slot_disagreements(spark: SparkSession, sf: str) -> DataFrame:
    return K.slot_disagreements(_judged_gold(spark, sf))


def reading_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered readings taken apart again."""
    tags = treebank(spark, sf).select(tag_reading(F.col("postag")).alias("reading")).where("reading != ''").distinct()
    return tags.select("reading", *[slot_of(F.col("reading"), s).alias(s) for s in SLOTS if s != "clitic"])


def treebank_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by form and lemma, by form, lemma and tag, and by lemma, from one scan."""
    rows = treebank(spark, sf)
    sets = rows.groupingSets([["form", "lemma"], ["form", "lemma", "postag"], ["lemma"]], "form", "lemma", "postag")
    return sets.agg(F.grouping_id().alias("grouped"), F.count(F.lit(1)).alias("n")).select("form", "lemma", "postag", F.col("grouped").cast("bigint").alias("grouped"), "n")


def package_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Of the forms of the regular classes: rows, distinct cells, share of blank cells, and a hash of all rows in any order."""
    rows = P.expand(table(spark, sf, "entry", "idx", "headword", "body"))
    part = F.conv(F.substring(F.md5(F.concat_ws("|", "idx", "form", "cell")), 1, 8), 16, 10).cast("bigint")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cell").alias("cells"), F.round(F.avg((F.col("cell") == "").cast("int")), 6).alias("blank"), F.sum(part).alias("hash"))


def origin_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Where the candidates come from: told of a build, not written into its rows."""
    return confidence_blend(spark, sf).groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("form").alias("forms"))


def impact(spark: SparkSession, sf: str) -> DataFrame:
    """``(freq, form, gloss, flags)``: corpus forms that are headwords, with their glosses and the detectors' flags, sorted."""
    rows = glosses_with_reasons(spark, sf).select(N.letters(N.split_number(F.col("key"))[0]).alias("w"), F.trim(F.coalesce("gloss", F.lit(""))).alias("gloss"), "reasons").where("w != ''")
    by = rows.groupBy("w").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("gloss") != "", F.col("reasons")))))).alias("flags"), F.array_sort(F.collect_set(F.when(F.col("gloss") != "", F.col("gloss")))).alias("g"))
    by = by.select(F.translate("w", "jv", "iu").alias("form"), "flags", "g").groupBy("form").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("g")))).alias("g"))
    joined = form_counts(spark, sf).join(by, "form")
    return joined.select(F.col("n").alias("freq"), "form", F.when(F.size("g") == 0, "(no gloss)").otherwise(F.substring(F.array_join("g", " | "), 1, 60)).alias("gloss"), F.when(F.size("g") == 0, "empty").otherwise(F.array_join("flags", ",")).alias("flags"))


def defect_targets(spark: SparkSession, sf: str, top: int = 500) -> DataFrame:
    """The defects that most tokens meet."""
    return impact(spark, sf).where("flags != ''").orderBy(F.col("freq").desc(), F.col("form").desc()).limit(top)


def impact_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of all tokens: whose form is a headword, whose gloss is there, and whose gloss is flagged."""
    total = form_counts(spark, sf).agg(F.sum("n").alias("tokens"))
    got = impact(spark, sf).agg(
        F.sum("freq").alias("covered"), F.sum(F.when(F.col("flags") != "empty", F.col("freq")).otherwise(0)).alias("glossed"), F.sum(F.when((F.col("flags") != "") & (F.col("flags") != "empty"), F.col("freq")).otherwise(0)).alias("flagged")
    )
    one = total.withColumn("k", F.lit(1)).join(got.withColumn("k", F.lit(1)), "k").drop("k")
    return one.select("tokens", *[F.round(100 * F.coalesce(F.col(c), F.lit(0)) / F.col("tokens"), 3).alias(f"{c}_pct") for c in ("covered", "glossed", "flagged")])


def score_by_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Mean score and share of good scores per pass with at least 20 of them."""
    j = _judges(spark, sf).groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("a"), 6).alias("mean"), F.round(F.avg((F.col("a") >= 4).cast("int")), 6).alias("good"))
    return j.where("n >= 20")


def filled_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The text each answer was asked with: its pass's instruction with headword and article put in."""
    prompts = table(spark, sf, "prompt_text")
    rows = table(spark, sf, "freqfix_fw_headings2_ckpt", "rec_id", "i", "p").join(table(spark, sf, "entry", "idx", "headword", "body"), F.col("i") == F.col("idx"))
    joined = rows.select("rec_id", "p", "headword", F.col("body").alias("article")).join(prompts.select(F.col("pass_name").alias("p"), "body"), "p")
    return joined.select("rec_id", F.md5(T.fill_template(F.col("body"), HEAD=F.col("headword"), ENTRY=F.col("article"))).alias("asked"))


def word_list(spark: SparkSession, sf: str) -> DataFrame:
    """Words of three letters or more in the articles, in lower case."""
    bodies = spread(table(spark, sf, "entry", "idx", "body"), "idx")
    return bodies.select(F.explode(F.regexp_extract_all(F.lower("body"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def coined_words(spark: SparkSession, sf: str) -> DataFrame:
    """Answers whose first part of five letters or more that no article has may be coined: ``(rec_id, word)``."""
    rows = table(spark, sf, "freqfix_fw_headings2_ckpt", "rec_id", "g").where("g is not null")
    parts = rows.select("rec_id", F.posexplode(F.regexp_extract_all(F.lower("g"), F.lit("[a-z]{5,}"), F.lit(0))).alias("pos", "word"))
    return parts.join(word_list(spark, sf).select("word"), "word", "left_anti").groupBy("rec_id").agg(F.min_by("word", "pos").alias("word"))


def headline_forms(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "entry", "idx", "body").select("idx", F.explode(T.headline_forms(F.col("body"))).alias("form"))


def _material(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "entry", "idx", "headword", "body")
    targets = last_targets(materialise(pointer_edges(spark, sf), "edges"), entries.where("length(body) < 200").select(F.col("idx").alias("node")))
    other = entries.select(F.col("idx").alias("dst"), F.col("headword").alias("other"), F.col("body").alias("target"))
    return entries.join(targets.join(other, "dst").select(F.col("src").alias("idx"), "other", "target"), "idx", "left")


def judging_material(spark: SparkSession, sf: str) -> DataFrame:
    """What a gloss is judged against: the article's own text, or for a pointer its target's text under a note that says so."""
    rows = _material(spark, sf)
    mark = F.coalesce(T.pos_marker(F.col("body")), F.lit("form"))
    note = F.concat("headword", F.lit(": a "), mark, F.lit(" that stands for "), "other", F.lit("\n"))
    shown = F.when(F.col("target").isNull(), T.focus(F.col("body"))).otherwise(F.concat(note, T.focus(F.col("target"))))
    return rows.select("idx", F.md5(shown).alias("shown"))


def repair_by_class(spark: SparkSession, sf: str) -> DataFrame:
    """Pointers whose own part of speech differs from that of what they point at: their taken-over gloss cannot fit."""
    e = table(spark, sf, "entry", "idx", "body").select("idx", T.pos_marker(F.col("body")).alias("mark"))
    edges = pointer_edges(spark, sf)
    rows = edges.join(e.select(F.col("idx").alias("src"), F.col("mark").alias("own")), "src").join(e.select(F.col("idx").alias("dst"), F.col("mark").alias("other")), "dst")
    return rows.where("own is not null and other is not null and own != other").select("src", "own", "other")


def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entry", "idx", "key", "headword")
    return K.positional_zip(e.select("idx", "key"), e.select("idx", "headword")).select("idx", "key", "headword")


def oversampled(spark: SparkSession, sf: str, n: int = 200) -> DataFrame:
    """A sample over all answers, a little larger than asked for, of which those that say something stay: the same rows whatever is empty."""
    from glossaria.operators.sampling import oversample

    return oversample(table(spark, sf, "freqfix_fw_headings2_ckpt", "rec_id", "g"), "rec_id", n, F.coalesce(F.trim("g") != "", F.lit(False))).select("rec_id")


QUERIES = {
    f.__name__: f
    for f in (
        primary_senses, lead_by_majority, enclitic_rows, gold_outcomes, slot_disagreements, reading_slots, treebank_sets, package_checks, origin_counts, score_by_pass,
        filled_prompts, word_list, coined_words, headline_forms, judging_material, repair_by_class, positional_zip,
    )
}
QUERIES |= {"defect_targets": lambda spark, sf: defect_targets(spark, sf), "impact_shares": impact_shares, "oversampled": lambda spark, sf: oversampled(spark, sf)}
_FOCUS = _SPACE.format(x=f"split_part(body, ',', 1) || ': ' || {_peeled('body')}")
_MARK = f"(CASE {_POS} WHEN '' THEN NULL WHEN 'prep' THEN 'praep' ELSE {_POS} END)"
_BARE = "regexp_replace({x}, '[0-9]+$', '')"
_SLOT_SQL = {
    "person": "0 1 2 3", "case": "nom gen dat acc abl voc loc", "number": "s p", "gender": "m f n c", "tense": "pres impf fut perf plup futp", "voice": "active passive",
    "mood": "ind sub inf imp part", "category": "pron prep conj adv interj",
}


def _slot_sql(reading: str, slot: str) -> str:
    values = ", ".join(f"'{v}'" for v in _SLOT_SQL[slot].split())
    return f"list_filter(string_split({reading}, ' '), lambda t: list_contains([{values}], t))[1]"


_CLASH = " OR ".join(
    (f"(x.{s} <> y.{s} AND x.{s} <> 'c' AND y.{s} <> 'c')" if s == "gender" else f"coalesce(x.{s} <> y.{s}, false) OR (x.{s} IS NULL) <> (y.{s} IS NULL)" if s == "category" else f"coalesce(x.{s} <> y.{s}, false)").replace(
        "(x.gender <> y.gender AND", "(coalesce(x.gender <> y.gender, false) AND"
    )
    for s in _SLOT_SQL
)
_JUDGED = f"""
    made AS (SELECT idx, form, reading FROM ({_FORMS}) q),
    cells AS (SELECT idx, form, string_agg(reading, '|' ORDER BY reading) AS cell FROM made GROUP BY idx, form),
    pack AS (SELECT c.form, {N.sql_fold('headword')} AS lemma, arg_min(cell, c.idx) AS cell FROM cells c JOIN entry e ON e.idx = c.idx GROUP BY ALL),
    gold0 AS (SELECT {N.sql_fold('form')} AS form, {N.sql_fold(_BARE.format(x='lemma'))} AS lemma, {_sql_reading('postag')} AS reading FROM ({_TREEBANK}) t),
    near AS (SELECT form, min(lemma) AS near FROM pack GROUP BY form),
    gold AS (SELECT g.form, CASE WHEN length(reading) % 3 > 0 THEN coalesce(near, g.lemma) ELSE g.lemma END AS lemma, reading, count(*) AS n FROM gold0 g LEFT JOIN near ON near.form = g.form WHERE g.form <> '' AND reading <> '' GROUP BY ALL),
    joined AS (SELECT row_number() OVER () AS id, g.*, p.cell, g.form IN (SELECT form FROM pack) AS known FROM gold g LEFT JOIN pack p ON p.form = g.form AND p.lemma = g.lemma),
    said AS (SELECT id, r, {", ".join(f"{_slot_sql('r', s)} AS {s}" for s in _SLOT_SQL)} FROM (SELECT id, unnest(string_split(cell, '|')) AS r FROM joined WHERE cell <> '') u),
    told AS (SELECT id, {", ".join(f"{_slot_sql('reading', s)} AS {s}" for s in _SLOT_SQL)} FROM joined),
    fits AS (SELECT x.id, max(CASE WHEN {_CLASH} THEN 0 ELSE 1 END) AS ok FROM said x JOIN told y ON x.id = y.id GROUP BY x.id),
    judged AS (SELECT j.*, CASE WHEN NOT known THEN 'form not indexed' WHEN cell IS NULL THEN 'lemma not offered' WHEN cell = '' THEN 'no reading offered' WHEN list_contains(string_split(cell, '|'), reading) THEN 'exact' WHEN ok = 1 THEN 'compatible' ELSE 'contradicted' END AS outcome
               FROM joined j LEFT JOIN fits f ON f.id = j.id)"""
_ENC = """
    CASE WHEN {f} LIKE '%que' THEN (CASE WHEN length({f}) > 6 THEN 'que' ELSE '' END) WHEN {f} LIKE '%ve' OR {f} LIKE '%ue' THEN (CASE WHEN length({f}) > 5 THEN 've' ELSE '' END) ELSE '' END"""
ORACLE = {
    "primary_senses": f"""
        WITH last AS (SELECT key, arg_max_null(gloss, row_id) AS gloss, arg_max_null(source, row_id) AS source, count(*) FILTER (source IN ('treebank', 'tb_export')) AS seen FROM lemma_map WHERE key IS NOT NULL GROUP BY key),
        s AS (SELECT {_BARE.format(x='e.key')} AS lemma, idx, gloss, coalesce(source LIKE 'web%', false) AS pointer, length(body) AS size, seen, length(gloss) < 14 AS bad,
                     coalesce({_MARK} IN ('adv', 'conj', 'praep', 'pron', 'interj', 'num'), idx % 3 = 0) AS is_function
              FROM entry e JOIN last l ON l.key = e.key WHERE trim(gloss) <> ''),
        r AS (SELECT *, row_number() OVER w AS rank, first_value(CASE WHEN NOT bad THEN seen END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
              FROM s WINDOW w AS (PARTITION BY lemma ORDER BY pointer, size DESC, length(gloss), idx)),
        h AS (SELECT lemma, min(rank) AS head, arg_min(bad, rank) AS dropped FROM r WHERE NOT (bad AND is_function AND nxt IS NOT NULL AND seen <= nxt) GROUP BY lemma)
        SELECT r.lemma, idx, row_number() OVER (PARTITION BY r.lemma ORDER BY rank) AS n FROM r JOIN h ON h.lemma = r.lemma WHERE rank >= head AND NOT dropped AND NOT bad""",
    "lead_by_majority": f"""
        WITH m AS (SELECT {N.sql_fold('form')} AS form, key, lemma FROM lemma_map WHERE key IS NOT NULL AND lemma IS NOT NULL),
        c AS (SELECT form, key AS lemma, {_BARE.format(x='key')} AS bare, least(1.0, count(*) / 10) AS conf FROM m WHERE form <> '' GROUP BY ALL),
        v AS (SELECT form, lemma AS bare, count(*) AS n, sum(count(*)) OVER (PARTITION BY form) AS total FROM m WHERE form <> '' GROUP BY form, lemma),
        major AS (SELECT form, bare AS major FROM v WHERE total >= 5 AND 3 * n >= 2 * total),
        t AS (SELECT DISTINCT {_BARE.format(x='key')} AS bare, lemma AS target FROM m WHERE form <> '' AND {_BARE.format(x='key')} <> lemma),
        r AS (SELECT c.*, major, coalesce(bool_or(c.bare = major) OVER (PARTITION BY c.form), false) AS has FROM c LEFT JOIN major ON major.form = c.form)
        SELECT form, lemma, round(CASE WHEN lemma = major THEN 1.0 WHEN bare = major THEN 0.99 WHEN has THEN least(conf, 0.89) ELSE conf END, 6) AS conf
        FROM r WHERE major IS NULL OR has OR EXISTS (SELECT 1 FROM t WHERE t.bare = r.bare AND t.target = r.major)""",
    "enclitic_rows": f"""
        WITH base AS (SELECT form, lemma, conf, ord FROM ({_CANDIDATES}) c), heads AS (SELECT DISTINCT {N.sql_fold('headword')} AS form FROM entry),
        joined AS (SELECT translate(form || enc, 'jv', 'iu') AS form, form AS host, enc, lemma, conf * 0.75 AS conf, ord FROM base, (VALUES ('que'), ('ve')) e(enc) WHERE {_ENC.format(f='form')} = ''),
        j AS (SELECT * FROM joined WHERE {_ENC.format(f='form')} = enc AND form NOT IN (SELECT form FROM heads WHERE form IS NOT NULL)),
        every AS (SELECT form, lemma, conf, ord, NULL AS host FROM base UNION ALL SELECT form, lemma, conf, ord, host FROM j WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.form = j.form AND b.lemma = j.lemma)
                  UNION ALL SELECT form, NULL, 0.30, min(ord), NULL FROM j GROUP BY form),
        shipped AS (SELECT form, lemma FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY conf DESC, ord) AS r FROM every) q WHERE r <= 3 AND lemma IS NOT NULL),
        kept AS (SELECT * FROM every e WHERE host IS NULL OR EXISTS (SELECT 1 FROM shipped s WHERE s.form = e.host AND s.lemma = e.lemma)),
        told AS (SELECT *, bool_or(lemma IS NOT NULL) OVER (PARTITION BY form) AS any_left FROM kept)
        SELECT CASE WHEN lemma IS NULL THEN 'enclitic' WHEN host IS NOT NULL THEN 'joined' ELSE 'word' END AS kind, count(*) AS n, count(DISTINCT form) AS forms
        FROM told WHERE any_left OR form IN (SELECT form FROM heads WHERE form IS NOT NULL) GROUP BY ALL""",
    "gold_outcomes": f"WITH {_JUDGED} SELECT outcome, count(*) AS triples, CAST(sum(n) AS BIGINT) AS tokens FROM judged GROUP BY outcome",
    "slot_disagreements": f"""
        WITH {_JUDGED}, f AS (SELECT n, split_part(cell, '|', 1) AS r, reading FROM judged WHERE outcome = 'contradicted')
        SELECT slot, ours, gold, CAST(sum(n) AS BIGINT) AS n FROM ({" UNION ALL ".join(f"SELECT '{s}' AS slot, {_slot_sql('r', s)} AS ours, {_slot_sql('reading', s)} AS gold, n FROM f" for s in _SLOT_SQL)}) u
        WHERE gold IS NOT NULL AND (ours IS NULL OR ours <> gold) GROUP BY slot, ours, gold""",
    "reading_slots": f"SELECT DISTINCT reading, {', '.join(f'{_slot_sql('reading', s)} AS {s}' for s in _SLOT_SQL)} FROM (SELECT {_sql_reading('postag')} AS reading FROM ({_TREEBANK}) t) q WHERE reading <> ''",
    "treebank_sets": f"SELECT form, lemma, postag, grouping(form, lemma, postag) AS grouped, count(*) AS n FROM ({_TREEBANK}) t GROUP BY GROUPING SETS ((form, lemma), (form, lemma, postag), (lemma))",
    "package_checks": f"""
        SELECT count(*) AS n, count(DISTINCT cell) AS cells, round(avg(CASE WHEN cell = '' THEN 1 ELSE 0 END), 6) AS blank, CAST(sum(CAST('0x' || substr(md5(idx || '|' || form || '|' || cell), 1, 8) AS BIGINT)) AS BIGINT) AS hash
        FROM (SELECT idx, form, string_agg(reading, '|' ORDER BY reading) AS cell FROM ({_FORMS}) f GROUP BY idx, form) c""",
    "origin_counts": f"SELECT origin, count(*) AS n, count(DISTINCT form) AS forms FROM ({_CANDIDATES}) c GROUP BY origin",
    "score_by_pass": f"SELECT p, count(*) AS n, round(avg(a), 6) AS mean, round(avg(CASE WHEN a >= 4 THEN 1 ELSE 0 END), 6) AS good FROM ({_J}) j GROUP BY p HAVING count(*) >= 20",
    "filled_prompts": "SELECT rec_id, md5(replace(replace(t.body, '{HEAD}', headword), '{ENTRY}', e.body)) AS asked FROM freqfix_fw_headings2_ckpt k JOIN entry e ON k.i = e.idx JOIN prompt_text t ON t.pass_name = k.p",
    "word_list": "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(body), '[a-z]{3,}')) AS word FROM entry) w GROUP BY word",
    "coined_words": """
        SELECT rec_id, arg_min(word, pos) AS word FROM (SELECT rec_id, w[pos] AS word, pos FROM (SELECT rec_id, regexp_extract_all(lower(g), '[a-z]{5,}') AS w, unnest(range(1, len(regexp_extract_all(lower(g), '[a-z]{5,}')) + 1)) AS pos FROM freqfix_fw_headings2_ckpt WHERE g IS NOT NULL) u) p
        WHERE word NOT IN (SELECT unnest(regexp_extract_all(lower(body), '[a-z]{3,}')) FROM entry) GROUP BY rec_id""",
    "headline_forms": rf"""
        SELECT DISTINCT idx, form FROM (SELECT idx, {N.sql_fold('w')} AS form FROM (
            SELECT idx, unnest(regexp_extract_all(substr(t, 1, CASE WHEN stop = '' THEN length(t) ELSE strpos(t, stop) - 1 END), '[\p{{L}}^]+\.?')) AS w
            FROM (SELECT idx, substr(body, 1, 600) AS t, regexp_extract(substr(body, 1, 600), '(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])((?:v|adj|adv|pron|praep|prep|conj|interj|num|subst|comm|m|f|n|indecl|part)\.)', 0) AS stop FROM entry) x) y WHERE w NOT LIKE '%.') z WHERE length(form) > 1""",
    "judging_material": f"""
        WITH RECURSIVE {_EDGES}, short AS (SELECT idx AS node FROM entry WHERE length(body) < 200),
        walk AS (SELECT src, dst AS node_at, [src, dst] AS path, 1 AS hops FROM edges WHERE src IN (SELECT node FROM short)
                 UNION ALL SELECT w.src, e.dst, list_append(w.path, e.dst), w.hops + 1 FROM walk w JOIN edges e ON w.node_at = e.src WHERE w.hops < 4 AND w.node_at IN (SELECT node FROM short) AND NOT list_contains(w.path, e.dst)),
        t AS (SELECT src, arg_max(node_at, hops) AS dst FROM walk GROUP BY src),
        texts AS (SELECT idx, headword, coalesce({_MARK}, 'form') AS mark, {_FOCUS} AS shown FROM entry)
        SELECT a.idx, md5(CASE WHEN b.idx IS NULL THEN a.shown ELSE a.headword || ': a ' || a.mark || ' that stands for ' || b.headword || chr(10) || b.shown END) AS shown FROM texts a LEFT JOIN t ON t.src = a.idx LEFT JOIN texts b ON b.idx = t.dst""",
    "repair_by_class": f"WITH {_EDGES}, m AS (SELECT idx, {_MARK} AS mark FROM entry) SELECT src, a.mark AS own, b.mark AS other FROM edges JOIN m a ON a.idx = src JOIN m b ON b.idx = dst WHERE a.mark <> b.mark",
    "positional_zip": "SELECT idx, key, headword FROM entry",
    "oversampled": "SELECT rec_id FROM (SELECT rec_id, g FROM freqfix_fw_headings2_ckpt ORDER BY md5(rec_id || '#1'), rec_id LIMIT 230) s WHERE trim(g) <> '' ORDER BY rec_id LIMIT 200",
}
