"""Frequencies, coverage and text projections over the corpus and the lemma map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.functions import text as T
from glossaria.functions.readings import merge_readings, reading_class, tag_reading
from glossaria.operators.skew import spread
from glossaria.tables import table
from glossaria.workspace import materialise

TOKEN = r"[\p{L}\p{M}]+"


def corpus_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``(source, form)``: folded tokens of all documents; tokens without a letter a-z are dropped."""
    docs = spread(table(spark, sf, "documents", "doc_id", "source", "text"), "doc_id")
    tokens = docs.select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))).alias("token"))
    return tokens.select("source", N.fold(F.col("token")).alias("form")).where("form != ''")


def form_counts(spark: SparkSession, sf: str) -> DataFrame:
    # counted by token first: the fold then runs once per distinct token
    docs = spread(table(spark, sf, "documents", "doc_id", "text"), "doc_id")
    tokens = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return tokens.groupBy(N.fold(F.col("token")).alias("form")).agg(F.sum("n").alias("n")).where("form != ''")


def token_freq(spark: SparkSession, sf: str, least: int = 1) -> DataFrame:
    """``(form, n, share)`` of the forms that occur at least ``least`` times; the share is of all tokens, whatever ``least`` is."""
    counts = materialise(form_counts(spark, sf), "counts")  # read for the rows and for their total
    # the total as a scalar subquery: a window over everything would gather all forms in one task
    return spark.sql("SELECT form, n, round(n / (SELECT sum(n) FROM {counts}), 9) AS share FROM {counts} WHERE n >= {least}", counts=counts, least=least)


def fold_letters_plain(spark: SparkSession, sf: str) -> DataFrame:
    heads = table(spark, sf, "entry", "headword").distinct()
    return heads.select("headword", N.fold(F.col("headword")).alias("fold"), N.letters(F.col("headword")).alias("letters"), N.plain(F.col("headword")).alias("plain"))


def tag_strip(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entry", "idx", "headword", "body")
    marked = F.concat(F.lit('<entry id="'), "idx", F.lit('"><orth>'), "headword", F.lit("</orth>  <sense n='1'>"), "body", F.lit("</sense>\n</entry>"))
    return e.select("idx", T.strip_tags(marked).alias("body"), F.regexp_extract(marked, "<orth>([^<]*)</orth>", 1).alias("orth"))


def focus_articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "entry", "idx", "body").select("idx", T.focus(F.col("body")).alias("focused"), T.pos_marker(F.col("body")).alias("pos"))


def split_keys(spark: SparkSession, sf: str) -> DataFrame:
    stem, number = N.split_number(F.col("key"))
    return table(spark, sf, "entry", "idx", "key").select("idx", stem.alias("stem"), F.coalesce(number, F.lit(0)).cast("bigint").alias("number"))


def treebank(spark: SparkSession, sf: str) -> DataFrame:
    """``(form, lemma, postag)`` of all documents' lines of three fields."""
    lines = table(spark, sf, "documents", "text").select(F.explode(F.split("text", "\n")).alias("line"))
    f = F.split("line", "\t")
    rows = lines.where(F.size(f) == 3).select(f[0].alias("form"), f[1].alias("lemma"), f[2].alias("postag"))
    return rows.where("form != '' and lemma != '' and postag rlike '^[a-z0-9-]{9}$'")


_TREEBANK = r"""
    SELECT f[1] AS form, f[2] AS lemma, f[3] AS postag
    FROM (SELECT string_split(unnest(string_split(text, chr(10))), chr(9)) AS f FROM documents) l
    WHERE len(f) = 3 AND f[1] <> '' AND f[2] <> '' AND regexp_full_match(f[3], '[a-z0-9-]{9}')"""


def treebank_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return treebank(spark, sf).groupBy("form", "lemma", "postag").agg(F.count(F.lit(1)).alias("n"))


def postag_decode(spark: SparkSession, sf: str) -> DataFrame:
    tags = treebank(spark, sf).groupBy("postag").agg(F.count(F.lit(1)).alias("n"))
    reading = tag_reading(F.col("postag"))
    return tags.select("postag", reading.alias("reading"), reading_class(reading).alias("class"), "n")


def _sql_reading(tag: str) -> str:
    from glossaria.functions.readings import SLOTS, TAG_PLACES

    value = {slot: "CASE substr({t}, {i}, 1) {w} END".format(t=tag, i=i, w=" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items())) for i, (slot, table_) in enumerate(TAG_PLACES, 1)}
    value["person"] = f"CASE WHEN {value['mood']} = 'inf' AND {value['person']} IS NULL AND {value['case']} IS NULL THEN '0' ELSE {value['person']} END"
    return "concat_ws(' ', " + ", ".join(value[s] for s in SLOTS if s in value) + ")"


def reading_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = treebank(spark, sf).select("form", tag_reading(F.col("postag")).alias("reading"))
    return rows.groupBy("form").agg(F.collect_set("reading").alias("readings")).select("form", merge_readings(F.col("readings")).alias("cell"))


def mode_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    n = treebank(spark, sf).groupBy("form", "lemma").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("form").agg(F.max_by("lemma", F.struct("n", "lemma")).alias("lemma"), F.max("n").alias("n"), F.sum("n").alias("total"))


def majority_two_thirds(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "lemma_map", "form", "lemma").where("lemma is not null").groupBy(N.fold(F.col("form")).alias("form"), "lemma").agg(F.count(F.lit(1)).alias("k"))
    total = F.sum("k").over(Window.partitionBy("form"))
    return n.withColumn("total", total).where("total >= 5 and 3 * k >= 2 * total and form != ''").select("form", "lemma", "k", "total")


def known_forms(spark: SparkSession, sf: str) -> DataFrame:
    forms = table(spark, sf, "lemma_map", "form").distinct().select(N.fold(F.col("form")).alias("form"))
    return forms.where("form != ''").distinct()


def weighted_coverage(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents", "doc_id", "source", "text"), "doc_id")
    tokens = docs.select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))).alias("token")).groupBy("source", "token").agg(F.count(F.lit(1)).alias("n"))
    counts = tokens.groupBy("source", N.fold(F.col("token")).alias("form")).agg(F.sum("n").alias("n")).where("form != ''")
    known = known_forms(spark, sf).withColumn("known", F.lit(1))
    joined = counts.join(known, "form", "left")
    by = joined.groupBy("source").agg(F.sum("n").alias("tokens"), F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("n"))), F.lit(0)).alias("covered"), F.count(F.lit(1)).alias("forms"))
    return by.select("source", "tokens", "covered", "forms", F.round(F.col("covered") / F.col("tokens"), 6).alias("share"))


def missing_topk(spark: SparkSession, sf: str, k: int = 100) -> DataFrame:
    missing = form_counts(spark, sf).where("length(form) > 1").join(known_forms(spark, sf), "form", "left_anti")
    return missing.orderBy(F.col("n").desc(), "form").limit(k)


def entry_freq_sum(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lemma_map", "key", "form", "headword").where("key is not null")
    forms = lines.select("key", F.explode(F.array(F.col("form"), F.col("headword"))).alias("f")).where("f is not null").distinct()
    forms = forms.select("key", N.fold(F.col("f")).alias("form")).distinct()
    return forms.join(form_counts(spark, sf), "form").groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))


def doc_frequency_vocab(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lemma_map", "key", "headword", "gloss").where("gloss is not null and key is not null").groupBy("key", "gloss").agg(F.min("headword").alias("headword"))
    w = rows.select("key", N.letters(F.col("headword")).alias("h"), F.explode(F.split("gloss", r"[\s,;]+")).alias("w"))
    w = w.select("key", "h", N.letters(F.col("w")).alias("word")).where("word != '' and word != h").select("key", "word").distinct()
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n_entries"))


def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lemma_map", "gloss").where("gloss is not null").groupBy(F.size(T.words(F.col("gloss"))).cast("bigint").alias("n_words")).agg(F.count(F.lit(1)).alias("n"))


def source_mix(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "documents", "source").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return n.select("source", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def grounded_answers(spark: SparkSession, sf: str) -> DataFrame:
    """``(rec_id, i, p, g, raw)``: answers with the share of their words that their article grounds; articles are stemmed before the join."""
    from glossaria.functions.quality import grounding, known_stems

    answers = table(spark, sf, "freqfix_fw_headings2_ckpt", "rec_id", "i", "p", "g").where("g is not null")
    articles = spread(table(spark, sf, "entry", "idx", "body"), "idx").select("idx", known_stems(F.col("body")).alias("stems"))
    return answers.join(articles, answers["i"] == articles["idx"]).select("rec_id", "i", "p", "g", grounding(F.col("g"), F.col("stems")).alias("raw"))


def grounding_score(spark: SparkSession, sf: str) -> DataFrame:
    return grounded_answers(spark, sf).select("rec_id", F.round("raw", 6).alias("grounding"))


def length_by_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional means: words per answer, and of grounded and other answers, by pass with at least 20 answers."""
    scored = grounded_answers(spark, sf).withColumn("grounding", F.round("raw", 6))
    n = F.size(T.words(F.col("g")))
    by = scored.groupBy("p").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(n), 6).alias("mean_words"),
        F.round(F.avg(F.when(F.col("grounding") > 0, n)), 6).alias("mean_grounded"),
        F.round(F.avg(F.when(F.col("grounding") == 0, n)), 6).alias("mean_ungrounded"),
        F.round(F.avg((F.col("grounding") >= 0.5).cast("int")), 6).alias("share_half"),
    )
    return by.where("n >= 20")


_TOKENS = rf"SELECT source, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM documents"
_COUNTS = f"SELECT form, CAST(sum(n) AS BIGINT) AS n FROM (SELECT {N.sql_fold('token')} AS form, n FROM (SELECT token, count(*) AS n FROM ({_TOKENS}) t GROUP BY token) c) f WHERE form <> '' GROUP BY form"
_KNOWN = f"SELECT DISTINCT {N.sql_fold('form')} AS form FROM (SELECT DISTINCT form FROM lemma_map) l"
_STEMS = (
    "list_transform(list_filter(string_split(regexp_replace({x}, '[^a-z ]', ' ', 'g'), ' '), lambda w: length(w) > 2 AND NOT list_contains({stop}, w)), lambda w: substr(w, 1, greatest(4, length(w) - 2)))"
)


def _grounding_sql() -> str:
    from glossaria.functions.quality import STOP_WORDS

    stop = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
    gloss, body = (_STEMS.format(x=N.sql_strip_accents(c), stop=stop) for c in ("g", "body"))
    return f"""
        SELECT rec_id, p, g, CASE WHEN len(gs) = 0 THEN 1.0 ELSE round(len(list_filter(gs, lambda s: list_contains(bs, s))) / len(gs), 6) END AS grounding
        FROM (SELECT rec_id, p, g, {gloss} AS gs, {body} AS bs FROM freqfix_fw_headings2_ckpt k JOIN entry e ON k.i = e.idx WHERE g IS NOT NULL) x"""


_WORDS = r"list_filter(string_split(trim(regexp_replace({x}, '[\s\x{{00A0}}\x{{2007}}\x{{202F}}]+', ' ', 'g')), ' '), lambda w: w <> '')"
_HEAD = "'<entry id=\"' || idx || '\"><orth>' || headword || '</orth>  <sense n=''1''>' || body || '</sense>' || chr(10) || '</entry>'"
_SPACE = r"trim(regexp_replace({x}, '[\s\x{{00A0}}\x{{2007}}\x{{202F}}]+', ' ', 'g'))"


def _peeled(x: str) -> str:
    for _ in range(8):
        x = rf"regexp_replace(regexp_replace({x}, '\([^()]*\)', ' ', 'g'), '\[[^\[\]]*\]', ' ', 'g')"
    return x


_POS = r"lower(regexp_replace(regexp_extract(substr(body, 1, 150), '(?i)(?:^|[^\p{L}\p{M}])(adv|adj|praep|prep|conj|pron|interj|v\.\s*(?:a|n|dep|freq|impers)|subst|num)(?:[^\p{L}\p{M}]|$)', 1), '\s+', '', 'g'))"

QUERIES = {
    "token_freq": lambda spark, sf: token_freq(spark, sf),
    "fold_letters_plain": fold_letters_plain,
    "tag_strip": tag_strip,
    "focus_articles": focus_articles,
    "split_keys": split_keys,
    "treebank_tokens": treebank_tokens,
    "postag_decode": postag_decode,
    "reading_merge": reading_merge,
    "mode_tiebreak": mode_tiebreak,
    "majority_two_thirds": majority_two_thirds,
    "weighted_coverage": weighted_coverage,
    "missing_topk": missing_topk,
    "entry_freq_sum": entry_freq_sum,
    "doc_frequency_vocab": doc_frequency_vocab,
    "length_histogram": length_histogram,
    "source_mix": source_mix,
    "grounding_score": lambda spark, sf: grounding_score(spark, sf),
    "length_by_pass": length_by_pass,
}
ORACLE = {
    "token_freq": f"SELECT form, n, round(n / sum(n) OVER (), 9) AS share FROM ({_COUNTS}) c",
    "fold_letters_plain": f"SELECT DISTINCT headword, {N.sql_fold('headword')} AS fold, {N.sql_letters('headword')} AS letters, {N.sql_plain('headword')} AS plain FROM entry",
    "tag_strip": f"SELECT idx, {_SPACE.format(x=f'''regexp_replace({_HEAD}, '<[^>]+>', '', 'g')''')} AS body, headword AS orth FROM entry",
    "focus_articles": f"SELECT idx, {_SPACE.format(x=f'''split_part(body, ',', 1) || ': ' || {_peeled('body')}''')} AS focused, CASE {_POS} WHEN '' THEN NULL WHEN 'prep' THEN 'praep' ELSE {_POS} END AS pos FROM entry",
    "split_keys": "SELECT idx, regexp_replace(key, '[0-9]+$', '') AS stem, coalesce(TRY_CAST(nullif(regexp_extract(key, '([0-9]+)$', 1), '') AS BIGINT), 0) AS number FROM entry",
    "treebank_tokens": f"SELECT form, lemma, postag, count(*) AS n FROM ({_TREEBANK}) t GROUP BY ALL",
    "postag_decode": f"""
        SELECT postag, reading, CASE WHEN regexp_matches(reading, '\\b(prep|conj|adv|interj)\\b') THEN 'indeclinable'
            WHEN regexp_matches(reading, '\\b(ind|sub|inf|imp|part)\\b') THEN 'verb form' WHEN regexp_matches(reading, '\\b(nom|gen|dat|acc|abl|voc|loc)\\b') THEN 'nominal form' ELSE 'other' END AS class, n
        FROM (SELECT postag, {_sql_reading('postag')} AS reading, count(*) AS n FROM ({_TREEBANK}) t GROUP BY ALL) x""",
    "reading_merge": f"""
        WITH r AS (SELECT DISTINCT form, {_sql_reading('postag')} AS reading FROM ({_TREEBANK}) t),
        kept AS (SELECT a.form, a.reading FROM r a WHERE a.reading <> '' AND NOT EXISTS (
            SELECT 1 FROM r b WHERE b.form = a.form AND b.reading <> a.reading AND len(list_filter(string_split(a.reading, ' '), lambda t: NOT list_contains(string_split(b.reading, ' '), t))) = 0))
        SELECT f.form, coalesce(string_agg(k.reading, '|' ORDER BY k.reading), '') AS cell FROM (SELECT DISTINCT form FROM r) f LEFT JOIN kept k ON f.form = k.form GROUP BY f.form""",
    "mode_tiebreak": f"""
        SELECT form, lemma, n, CAST(total AS BIGINT) AS total FROM (
            SELECT form, lemma, n, sum(n) OVER (PARTITION BY form) AS total, row_number() OVER (PARTITION BY form ORDER BY n DESC, lemma DESC) AS r
            FROM (SELECT form, lemma, count(*) AS n FROM ({_TREEBANK}) t GROUP BY ALL) c) x WHERE r = 1""",
    "majority_two_thirds": f"""
        SELECT form, lemma, k, CAST(total AS BIGINT) AS total FROM (SELECT form, lemma, k, sum(k) OVER (PARTITION BY form) AS total FROM (
            SELECT {N.sql_fold('form')} AS form, lemma, count(*) AS k FROM lemma_map WHERE lemma IS NOT NULL GROUP BY ALL) c) x WHERE total >= 5 AND 3 * k >= 2 * total AND form <> ''""",
    "weighted_coverage": f"""
        SELECT source, CAST(sum(n) AS BIGINT) AS tokens, CAST(coalesce(sum(CASE WHEN k.form IS NOT NULL THEN n END), 0) AS BIGINT) AS covered, count(*) AS forms,
               round(coalesce(sum(CASE WHEN k.form IS NOT NULL THEN n END), 0) / sum(n), 6) AS share
        FROM (SELECT source, form, sum(n) AS n FROM (SELECT source, {N.sql_fold('token')} AS form, n FROM (SELECT source, token, count(*) AS n FROM ({_TOKENS}) t GROUP BY ALL) c) f WHERE form <> '' GROUP BY ALL) d
        LEFT JOIN (SELECT form FROM ({_KNOWN}) y WHERE form <> '') k ON d.form = k.form GROUP BY source""",
    "missing_topk": f"SELECT form, n FROM ({_COUNTS}) c WHERE length(form) > 1 AND form NOT IN (SELECT form FROM ({_KNOWN}) k WHERE form IS NOT NULL) ORDER BY n DESC, form LIMIT 100",
    "entry_freq_sum": f"""
        SELECT key, CAST(sum(n) AS BIGINT) AS n, count(*) AS forms FROM (
            SELECT DISTINCT key, {N.sql_fold('f')} AS form FROM (SELECT DISTINCT key, unnest([form, headword]) AS f FROM lemma_map WHERE key IS NOT NULL) l WHERE f IS NOT NULL) d
        JOIN ({_COUNTS}) c ON d.form = c.form GROUP BY key""",
    "doc_frequency_vocab": rf"""
        SELECT word, count(*) AS n_entries FROM (
            SELECT DISTINCT key, word FROM (SELECT key, {N.sql_letters('headword')} AS h, {N.sql_letters('w')} AS word FROM (
                SELECT key, headword, unnest(regexp_split_to_array(gloss, '[\s,;]+')) AS w FROM (SELECT key, gloss, min(headword) AS headword FROM lemma_map WHERE gloss IS NOT NULL AND key IS NOT NULL GROUP BY ALL) g) u) x
            WHERE word <> '' AND word <> h) d GROUP BY word""",
    "length_histogram": f"SELECT len({_WORDS.format(x='gloss')}) AS n_words, count(*) AS n FROM lemma_map WHERE gloss IS NOT NULL GROUP BY ALL",
    "source_mix": "SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY source",
    "grounding_score": f"SELECT rec_id, grounding FROM ({_grounding_sql()}) q",
    "length_by_pass": f"""
        SELECT p, count(*) AS n, round(avg(w), 6) AS mean_words, round(avg(CASE WHEN grounding > 0 THEN w END), 6) AS mean_grounded,
               round(avg(CASE WHEN grounding = 0 THEN w END), 6) AS mean_ungrounded, round(avg(CASE WHEN grounding >= 0.5 THEN 1 ELSE 0 END), 6) AS share_half
        FROM (SELECT *, len({_WORDS.format(x='g')}) AS w FROM ({_grounding_sql()}) q) s GROUP BY p HAVING count(*) >= 20""",
}
