"""Candidates, pointers, homographs and gates over the lemma map and the dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.functions import text as T
from glossaria.operators.pointers import chase, first_wins_index, numbered_index, resolve_targets
from glossaria.operators.ranking import confidence, frequency_band, keep_best, majority_leads, numbered_names, top_k
from glossaria.plans.corpus import _COUNTS, _KNOWN, form_counts, known_forms
from glossaria.tables import table
from glossaria.workspace import materialise

# The lemma map's feeds as origins of candidates.
ORIGINS = {"rules": "rules", "treebank": "treebank", "tb_export": "treebank", "handlist": "headword"}


def _origin_sql(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORIGINS.items()) + " ELSE 'model' END"


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """``(form, lemma, conf, support, ord)``: candidates of all feeds, the best of each (form, lemma)."""
    rows = table(spark, sf, "lemma_map", "row_id", "form", "lemma", "source", "freq").where("lemma is not null")
    origin = F.lit("model")
    for feed, name in ORIGINS.items():
        origin = F.when(F.col("source") == feed, name).otherwise(origin)
    rows = rows.select(N.fold(F.col("form")).alias("form"), "lemma", origin.alias("origin"), "freq", "row_id").where("length(form) between 2 and 40")
    lines = rows.groupBy("form", "lemma", "origin").agg(F.max("freq").alias("freq"), F.min("row_id").alias("ord"), F.count(F.lit(1)).alias("k"))
    total = lines.where("origin = 'treebank'").groupBy("form").agg(F.sum("k").alias("total"))
    lines = lines.join(total, "form", "left")
    scored = lines.withColumn("conf", F.round(confidence(F.col("origin"), F.col("k") / F.col("total"), F.col("form"), F.col("freq")), 9))
    return keep_best(scored, ["form", "lemma"], "conf", "ord", ["ord", "origin"], F.sum("k").alias("support"))


_CANDIDATES = f"""
    SELECT form, lemma, conf, ord, origin, CAST(support AS BIGINT) AS support FROM (
        SELECT *, row_number() OVER (PARTITION BY form, lemma ORDER BY conf DESC, ord) AS r, sum(k) OVER (PARTITION BY form, lemma) AS support FROM (
            SELECT form, lemma, origin, ord, k, round(least(1.0, CASE origin WHEN 'headword' THEN 1.0 WHEN 'treebank' THEN 0.90 + 0.09 * (k / total)
                WHEN 'rules' THEN (CASE WHEN length(form) < 5 THEN 0.35 ELSE 0.85 END) * w ELSE 0.5 * w END), 9) AS conf
            FROM (SELECT l.*, sum(CASE WHEN origin = 'treebank' THEN k END) OVER (PARTITION BY form) AS total, 0.5 + 0.5 * least(1.0, log10(coalesce(freq, 0) + 1) / 4) AS w FROM (
                SELECT {N.sql_fold('form')} AS form, lemma, {_origin_sql('source')} AS origin, max(freq) AS freq, min(row_id) AS ord, count(*) AS k
                FROM lemma_map WHERE lemma IS NOT NULL GROUP BY ALL) l WHERE length(form) BETWEEN 2 AND 40) t) c) x WHERE r = 1"""
_LED = """
    SELECT form, lemma, origin, ord, support, CASE WHEN leads THEN 1.0 WHEN max(CASE WHEN leads THEN 1 ELSE 0 END) OVER (PARTITION BY form) = 1 THEN least(conf, 0.89) ELSE conf END AS conf
    FROM (SELECT *, support * 3 >= sum(support) OVER (PARTITION BY form) * 2 AND sum(support) OVER (PARTITION BY form) >= 5 AS leads FROM ({c}) c) m""".format(c=_CANDIDATES)


def confidence_blend(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf).select("form", "lemma", "conf", "ord", "origin", "support")


def led_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return majority_leads(candidates(spark, sf), "form", "lemma", "support", "conf")


def top3_candidates(spark: SparkSession, sf: str) -> DataFrame:
    best = top_k(led_candidates(spark, sf), ["form"], [F.col("conf").desc(), F.col("ord")], 3)
    return best.select("form", "lemma", "conf", F.col("rank").cast("bigint").alias("rank"))


def candidate_counts(spark: SparkSession, sf: str) -> DataFrame:
    n = candidates(spark, sf).groupBy("form").agg(F.count(F.lit(1)).alias("n_candidates"))
    return n.groupBy("n_candidates").agg(F.count(F.lit(1)).alias("n_forms"))


def enclitic_split(spark: SparkSession, sf: str) -> DataFrame:
    """Forms that split into a host that is itself a form, and are no headword: ``(form, host, enclitic)``."""
    forms = materialise(known_forms(spark, sf), "forms")  # read twice, and its fold would else be copied into every branch of the split
    host, name = T.split_enclitic(F.col("form"))
    split = forms.select("form", host.alias("host"), name.alias("enclitic")).where("enclitic != ''")
    heads = table(spark, sf, "entry", "headword").select(N.fold(F.col("headword")).alias("form")).distinct()
    return split.join(forms.select(F.col("form").alias("host")), "host", "left_semi").join(heads, "form", "left_anti").select("form", "host", "enclitic")


_SPLIT = """
    SELECT form, CASE WHEN enclitic = 'que' THEN left(form, length(form) - 3) ELSE left(form, length(form) - 2) END AS host, enclitic FROM (
        SELECT form, CASE WHEN form LIKE '%que' THEN (CASE WHEN length(form) > 6 THEN 'que' END) WHEN (form LIKE '%ve' OR form LIKE '%ue') AND length(form) > 5 THEN 've' END AS enclitic
        FROM ({k}) k WHERE form <> '') s WHERE enclitic IS NOT NULL""".format(k=_KNOWN)


def enclitic_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """After the cap: split forms whose host did not ship any candidate; they would be dropped."""
    shipped = top3_candidates(spark, sf).select("form").distinct()
    host, name = T.split_enclitic(F.col("form"))
    split = shipped.select("form", host.alias("host"), name.alias("enclitic")).where("enclitic != ''")
    return split.join(shipped.select(F.col("form").alias("host")), "host", "left_anti").groupBy("enclitic").agg(F.count(F.lit(1)).alias("n"))


def pointer_edges(spark: SparkSession, sf: str) -> DataFrame:
    """``(src, dst)``: the entry that the first reference in an entry's texts points at.

    References name inflected forms; a form stands for the first entry that the lemma map gives it.
    """
    docs = table(spark, sf, "documents", "doc_id", "entry_key", "text", "source").where("entry_key is not null")
    number, word = T.reference_target(F.col("text"))
    refs = docs.select("doc_id", "entry_key", word.alias("word"), number.alias("number")).where("word is not null")
    refs = refs.groupBy("entry_key").agg(F.min_by(F.struct("word", "number"), F.col("doc_id")).alias("r")).select("entry_key", N.letters(F.col("r.word")).alias("word"), "r.number")
    entries = table(spark, sf, "entry", "idx", "key", "headword")
    of_key = entries.groupBy("key").agg(F.min("idx").alias("src"))
    forms = table(spark, sf, "lemma_map", "form", "key").where("key is not null").select(N.letters(F.col("form")).alias("word"), "key").join(of_key, "key")
    forms = forms.groupBy("word").agg(F.min("src").alias("idx"))
    index = first_wins_index(entries, "idx", "key", "headword")
    both = forms.join(index, "word", "left_anti").unionByName(index)
    return resolve_targets(refs.join(of_key, refs["entry_key"] == of_key["key"]).select("src", "word", "number"), both, numbered_index(entries, "idx", "key"))


def pointer_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Chains of pointers to the first entry that is shipped, at most four hops, never in a circle."""
    edges = materialise(pointer_edges(spark, sf), "edges")
    entries = table(spark, sf, "entry", "idx", "headword")
    shipped = table(spark, sf, "package_dictionary", "lemma", "definition").where("definition is not null").select(N.letters(F.col("lemma")).alias("w")).distinct()
    stops = entries.select(F.col("idx").alias("node"), N.letters(F.col("headword")).alias("w")).join(shipped, "w", "left_semi").select("node")
    return chase(edges.select("src"), edges, stops)


def pointer_short(spark: SparkSession, sf: str) -> DataFrame:
    """Chains that go on only while the article reached is itself short: they stop at the first of 200 characters or more."""
    edges = materialise(pointer_edges(spark, sf), "edges")
    stops = table(spark, sf, "entry", "idx", "body").where("length(body) >= 200").select(F.col("idx").alias("node"))
    return chase(edges.select("src"), edges, stops)


_WORD = r"[A-Za-zÀ-ɏ''-]+"
_REFS = rf"""
    SELECT entry_key, {N.sql_letters('word')} AS word FROM (
        SELECT entry_key, doc_id, word, row_number() OVER (PARTITION BY entry_key ORDER BY doc_id) AS r FROM (
            SELECT entry_key, doc_id, list_filter(regexp_extract_all(regexp_replace(text, '\([^()]*\)', ' ', 'g'), '(?:^|[^A-Za-z])(?:(?i:v\.|vide|cf\.|q\.\s*v\.))\s*({_WORD})', 1),
                lambda w: length(w) > 1 AND NOT list_contains(['a','n','act','pass','dep','semidep','freq','inch','incoh','impers','intens','desid','defect','irreg'], lower(w)))[1] AS word
            FROM documents WHERE entry_key IS NOT NULL) d WHERE word IS NOT NULL) x WHERE r = 1"""
_INDEX = f"""
    SELECT word, min(idx) AS idx FROM (SELECT idx, unnest([{N.sql_letters('headword')}, {N.sql_letters("regexp_replace(key, '[0-9]+$', '')")}]) AS word FROM entry) i WHERE word <> '' AND word IS NOT NULL GROUP BY word"""
_EDGES = f"""
    idx0 AS ({_INDEX}), ofkey AS (SELECT key, min(idx) AS src FROM entry GROUP BY key),
    forms AS (SELECT {N.sql_letters('form')} AS word, min(o.src) AS idx FROM lemma_map m JOIN ofkey o ON m.key = o.key GROUP BY ALL),
    names AS (SELECT * FROM idx0 UNION ALL SELECT * FROM forms WHERE word NOT IN (SELECT word FROM idx0)),
    edges AS (SELECT o.src, n.idx AS dst FROM ({_REFS}) r JOIN ofkey o ON r.entry_key = o.key JOIN names n ON n.word = r.word WHERE n.idx <> o.src)"""
_CHASE = """
    WITH RECURSIVE {edges}, stops AS ({stops}),
    walk AS (
        SELECT src, dst AS node_at, [src, dst] AS path, 1 AS hops, dst IN (SELECT node FROM stops) AS done FROM edges
        UNION ALL
        SELECT w.src, e.dst, list_append(w.path, e.dst), w.hops + 1, e.dst IN (SELECT node FROM stops) FROM walk w JOIN edges e ON w.node_at = e.src
        WHERE NOT w.done AND w.hops < 4 AND NOT list_contains(w.path, e.dst))
    SELECT src, node_at AS dst, hops FROM walk WHERE done"""


def neighbour_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each entry with its neighbours by an equi-join on the position, not by an order over everything."""
    e = table(spark, sf, "entry", "idx", "key")
    before = e.select((F.col("idx") + 1).alias("idx"), F.col("key").alias("before"))
    after = e.select((F.col("idx") - 1).alias("idx"), F.col("key").alias("after"))
    return e.join(before, "idx", "left").join(after, "idx", "left").select("idx", "key", "before", "after")


def first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return first_wins_index(table(spark, sf, "entry", "idx", "key", "headword"), "idx", "key", "headword")


def homograph_names(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entry", "idx", "key", "body")
    rows = e.select("idx", N.split_number(F.col("key"))[0].alias("stem"), F.length("body").alias("size"))
    return numbered_names(rows, "stem", [F.col("size").desc(), F.col("idx")]).select("idx", "stem", "name", F.col("rank").cast("bigint").alias("rank"))


def decisive_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Per homograph group: the entry with most lines and the one with most frequency, and whether they decide (twice the second and five lines)."""
    lines = table(spark, sf, "lemma_map", "key", "freq").where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("freq"), F.lit(0)).alias("f"))
    rows = lines.withColumn("stem", N.split_number(F.col("key"))[0])
    by = rows.groupBy("stem").agg(
        F.max_by("key", F.struct("n", "key")).alias("most_lines"),
        F.max_by("key", F.struct("f", "key")).alias("most_freq"),
        F.max("n").alias("first"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("keys"),
    )
    return by.where("keys > 1").select("stem", "most_lines", "most_freq", "first", "total", ((F.col("first") >= 2 * (F.col("total") - F.col("first"))) & (F.col("first") >= 5)).alias("decides"))


def freq_band(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "lemma_map", "lemma", "freq").where("lemma is not null").groupBy("lemma").agg(F.coalesce(F.sum("freq"), F.lit(0)).alias("freq"))
    return frequency_band(n, "freq", "lemma", 10, 50)


def gates(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose lemma is shipped (semi-join) while their key is no entry (anti-join), per feed."""
    rows = table(spark, sf, "lemma_map", "source", "lemma", "key")
    shipped = table(spark, sf, "package_dictionary", "lemma").distinct()
    entries = table(spark, sf, "entry", "key").distinct()
    return rows.join(shipped, "lemma", "left_semi").join(entries, "key", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def paradigm_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Forms that only a numbered homograph has, not the first of its name: per key their number."""
    rows = table(spark, sf, "lemma_map", "key", "form").where("key is not null").select("key", N.split_number(F.col("key"))[0].alias("stem"), N.fold(F.col("form")).alias("form")).distinct()
    first = rows.groupBy("stem").agg(F.min("key").alias("first"))
    tagged = rows.join(first, "stem")
    minor, major = tagged.where("key != first"), tagged.where("key = first").select("stem", "form")
    return minor.join(major, ["stem", "form"], "left_anti").groupBy("key").agg(F.count(F.lit(1)).alias("n_own"))


def lemma_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    """A form's lemma is accepted if it is shipped and shares a beginning of two letters and is at most two letters longer."""
    pairs = table(spark, sf, "lemma_map", "form", "lemma").where("lemma is not null").distinct()
    shipped = table(spark, sf, "package_dictionary", "lemma").distinct().withColumn("shipped", F.lit(1))
    f, w = N.letters(F.col("form")), N.letters(F.col("lemma"))
    fits = (F.substring(f, 1, 2) == F.substring(w, 1, 2)) & (F.length(f) >= 2) & (F.length(w) <= F.length(f) + 2)
    verdict = F.when(F.col("shipped").isNull(), "unknown lemma").when(fits, "accepted").otherwise("too far")
    return pairs.join(shipped, "lemma", "left").groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def form_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus frequencies attributed to entries: once for every entry that has the form."""
    links = table(spark, sf, "lemma_map", "form", "key").where("key is not null").select(N.fold(F.col("form")).alias("form"), "key").distinct()
    return links.join(form_counts(spark, sf), "form").groupBy("form").agg(F.count(F.lit(1)).alias("entries"), F.max("n").alias("n"), F.sum("n").alias("attributed"))


_STEM = "regexp_replace(key, '[0-9]+$', '')"
QUERIES = {
    "confidence_blend": confidence_blend,
    "majority_leads": lambda spark, sf: led_candidates(spark, sf).select("form", "lemma", "conf", "support"),
    "top3_candidates": top3_candidates,
    "candidate_counts": candidate_counts,
    "enclitic_split": enclitic_split,
    "enclitic_orphans": enclitic_orphans,
    "pointer_edges": pointer_edges,
    "pointer_resolve": pointer_resolve,
    "pointer_short": pointer_short,
    "neighbour_join": neighbour_join,
    "first_wins_index": first_wins,
    "homograph_names": homograph_names,
    "decisive_vote": decisive_vote,
    "freq_band": freq_band,
    "semi_anti_gates": gates,
    "paradigm_difference": paradigm_difference,
    "lemma_acceptance": lemma_acceptance,
    "form_frequencies": form_frequencies,
}
_TOP3 = f"SELECT form, lemma, conf, rank FROM (SELECT form, lemma, conf, row_number() OVER (PARTITION BY form ORDER BY conf DESC, ord) AS rank FROM ({_LED}) l) x WHERE rank <= 3"
ORACLE = {
    "confidence_blend": _CANDIDATES,
    "majority_leads": f"SELECT form, lemma, conf, support FROM ({_LED}) l",
    "top3_candidates": _TOP3,
    "candidate_counts": f"SELECT n_candidates, count(*) AS n_forms FROM (SELECT form, count(*) AS n_candidates FROM ({_CANDIDATES}) c GROUP BY form) x GROUP BY n_candidates",
    "enclitic_split": f"SELECT * FROM ({_SPLIT}) s WHERE host IN (SELECT form FROM ({_KNOWN}) k WHERE form IS NOT NULL) AND form NOT IN (SELECT {N.sql_fold('headword')} FROM entry)",
    "enclitic_orphans": f"""
        WITH shipped AS (SELECT DISTINCT form FROM ({_TOP3}) t)
        SELECT enclitic, count(*) AS n FROM ({_SPLIT}) s WHERE form IN (SELECT form FROM shipped) AND host NOT IN (SELECT form FROM shipped) GROUP BY enclitic""",
    "pointer_edges": f"WITH {_EDGES} SELECT src, dst FROM edges",
    "pointer_resolve": _CHASE.format(edges=_EDGES, stops=f"SELECT idx AS node FROM entry WHERE {N.sql_letters('headword')} IN (SELECT {N.sql_letters('lemma')} FROM package_dictionary WHERE definition IS NOT NULL)"),
    "pointer_short": _CHASE.format(edges=_EDGES, stops="SELECT idx AS node FROM entry WHERE length(body) >= 200"),
    "neighbour_join": "SELECT e.idx, e.key, b.key AS before, a.key AS after FROM entry e LEFT JOIN entry b ON b.idx = e.idx - 1 LEFT JOIN entry a ON a.idx = e.idx + 1",
    "first_wins_index": _INDEX,
    "homograph_names": f"SELECT idx, stem, stem || CASE WHEN rank > 1 THEN CAST(rank AS VARCHAR) ELSE '' END AS name, rank FROM (SELECT idx, {_STEM} AS stem, row_number() OVER (PARTITION BY {_STEM} ORDER BY length(body) DESC, idx) AS rank FROM entry) e",
    "decisive_vote": f"""
        SELECT stem, most_lines, most_freq, first, CAST(total AS BIGINT) AS total, first >= 2 * (total - first) AND first >= 5 AS decides FROM (
            SELECT {_STEM} AS stem, arg_max(key, (n, key)) AS most_lines, arg_max(key, (f, key)) AS most_freq, max(n) AS first, sum(n) AS total, count(*) AS keys
            FROM (SELECT key, count(*) AS n, CAST(coalesce(sum(freq), 0) AS BIGINT) AS f FROM lemma_map WHERE key IS NOT NULL GROUP BY key) l GROUP BY ALL) s WHERE keys > 1""",
    "freq_band": "SELECT lemma, CAST(coalesce(sum(freq), 0) AS BIGINT) AS freq FROM lemma_map WHERE lemma IS NOT NULL GROUP BY lemma ORDER BY freq DESC, lemma DESC LIMIT 50 OFFSET 10",
    "semi_anti_gates": "SELECT source, count(*) AS n FROM lemma_map m WHERE EXISTS (SELECT 1 FROM package_dictionary d WHERE d.lemma = m.lemma) AND NOT EXISTS (SELECT 1 FROM entry e WHERE e.key = m.key) GROUP BY source",
    "paradigm_difference": f"""
        WITH r AS (SELECT DISTINCT key, {_STEM} AS stem, {N.sql_fold('form')} AS form FROM lemma_map WHERE key IS NOT NULL),
        f AS (SELECT stem, min(key) AS first FROM r GROUP BY stem)
        SELECT r.key, count(*) AS n_own FROM r JOIN f ON r.stem = f.stem WHERE r.key <> f.first AND NOT EXISTS (SELECT 1 FROM r q WHERE q.key = f.first AND q.form = r.form) GROUP BY r.key""",
    "lemma_acceptance": f"""
        SELECT CASE WHEN NOT shipped THEN 'unknown lemma' WHEN left(f, 2) = left(w, 2) AND length(f) >= 2 AND length(w) <= length(f) + 2 THEN 'accepted' ELSE 'too far' END AS verdict, count(*) AS n
        FROM (SELECT {N.sql_letters('form')} AS f, {N.sql_letters('lemma')} AS w, lemma IN (SELECT lemma FROM package_dictionary WHERE lemma IS NOT NULL) AS shipped
              FROM (SELECT DISTINCT form, lemma FROM lemma_map WHERE lemma IS NOT NULL) d) x GROUP BY ALL""",
    "form_frequencies": f"""
        SELECT l.form, count(*) AS entries, max(n) AS n, CAST(sum(n) AS BIGINT) AS attributed FROM (SELECT DISTINCT {N.sql_fold('form')} AS form, key FROM lemma_map WHERE key IS NOT NULL) l
        JOIN ({_COUNTS}) c ON l.form = c.form GROUP BY l.form""",
}
