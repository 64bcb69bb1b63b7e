"""Texts that stop before their end, found by how phrases behave inside texts and at ends.

Every text is cut into word and mark tokens. Word trigrams are counted twice: inside texts and at
ends. A text's final trigram is joined with these counts, and it is cut

* if the trigram is frequent inside but almost never last ("one who lifts the"): test ``end``;
* if the trigrams that go on from it inside its last word are frequent while it is almost never there itself
  ("the entrance of an eveni"): test ``trigram``; where a trigram is too rare to tell, the same counts of its last
  bigram and of its last word decide: tests ``bigram`` and ``word``.

The counting unit is a distinct pair of owner and text. A text repeated a million times by one owner, cut
or not, counts once, so neither hot owners nor redelivered rows move the statistics; and a short but
complete text ("what kind of") is known by the many owners that end with it.

All of it is SQL over whole tables; nothing is sampled or collected but the hashes of hot texts, at most 256. The
trigram table is written once to the shared folder since three statements read it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaria.operators.skew import hot_hashes, spread_join
from glossaria.workspace import materialise

#: A word (letters, marks, inner apostrophes and hyphens), or one other visible character.
TOKEN = r"[\p{L}\p{M}\p{N}]+(?:[\x27’‑-][\p{L}\p{M}\p{N}]+)*|[^\s\p{L}\p{M}\p{N}]"
#: Beginnings of a word up to this length are counted for every word, longer ones where some text ends in one.
BEGINNING = 64


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict; counts are of distinct (owner, text) pairs, shares of all occurrences.

    support: so many longer words in a context (or so many of the word itself) let that context decide on a
    broken word; word_support: the same where only the word is left. exact_share: a word is broken if it is
    itself at most so frequent against the longer ones. known_inside and unknown_share: a word that stands
    inside so many texts, and against longer words so often, is known; known_support and known_share: what
    breaking off at a known word takes. prior: weight of the shorter context in the share
    of phrase ends. terminal_share: a phrase with a smaller share of ends cannot end there; the share is smoothed
    by the shorter contexts, so one that was never seen to end lies near a tenth of it.

    The hinted_ values hold instead for texts that something else hints at, as a length limit or a neighbour.
    """

    support: int = 6
    word_support: int = 20
    exact_share: float = 0.12
    unknown_share: float = 0.0005
    known_inside: int = 5
    known_support: int = 30
    known_share: float = 0.02
    prior: int = 8
    terminal_share: float = 0.2
    hinted_support: int = 2
    hinted_exact_share: float = 0.25
    hinted_known_support: int = 15
    hinted_known_share: float = 0.05
    hinted_terminal_share: float = 0.3


def _tokens(texts: DataFrame) -> DataFrame:
    """Adds ``toks``: tokens of the text without the marks set after a break and without closing marks."""
    return texts.sparkSession.sql(
        rf"""
        SELECT *, concat(array('^', '^'), transform(regexp_extract_all(body, r'{TOKEN.replace("{", "{{").replace("}", "}}")}', 0),
                         (t, i) -> CASE WHEN t RLIKE '^[0-9]+$' THEN '0' WHEN i = 0 AND length(t) > 1 THEN lower(t) ELSE t END)) AS toks
        FROM (
            SELECT *, regexp_replace(open_text, r'[.!?\s]+$', '') AS body, open_text RLIKE r'\.\s*$' AS dotted
            FROM (
                SELECT *, regexp_replace(regexp_replace(rtrim(' \n\t\r', text), r'\s*(?:\.\.\.|…)$', ''), r'^[“"«„](.*)[”"»]$', '$1') AS open_text
                FROM {{texts}}))
        """,
        texts=texts,
    )


def trigrams(units: DataFrame) -> DataFrame:
    """``(a, b, w, n_in, n_mark, n_dot, n_end, n_stop)`` of distinct (owner, text) pairs.

    n_end counts a trigram at the end of a text and n_stop at the end before a full stop; n_mark counts it
    inside before a mark that ends a phrase, n_dot inside before a full stop, n_in inside before anything else.
    """
    kinds = {"n_in": "in", "n_mark": "mark", "n_dot": "dot", "n_end": "end", "n_stop": "stop"}
    return units.sparkSession.sql(
        f"""
        SELECT a, b, w, {", ".join(f"sum(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS {n}" for n, k in kinds.items())}
        FROM (
            SELECT g.a, g.b, g.w, CASE WHEN g.next IS NULL THEN IF(dotted, 'stop', 'end') WHEN g.next IN (',', ';', ':') THEN 'mark' WHEN g.next = '.' THEN 'dot' ELSE 'in' END AS kind
            FROM (
                SELECT dotted, explode(transform(sequence(3, size(toks)),
                           i -> named_struct('a', toks[i - 3], 'b', toks[i - 2], 'w', toks[i - 1], 'next', get(toks, i)))) AS g
                FROM {{units}} WHERE size(toks) > 2))
        GROUP BY a, b, w
        """,
        units=_tokens(units),
    )


def _broken(support: str, exact: str, known_support: str, known_share: str, known_bigrams: str) -> str:
    """The test that finds the last word broken, or null; ``known_bigrams`` lets bigrams find a known word broken."""
    return f"""CASE
        WHEN NOT is_word THEN NULL
        WHEN l1 >= {{limits.word_support}} AND NOT known AND t1 <= {{limits.exact_share}} * l1 THEN IF(l3 >= {{limits.{support}}}, 'trigram', 'word')
        WHEN l3 >= {{limits.{support}}} OR n3 >= {{limits.{support}}}
            THEN CASE WHEN IF(known, l3 >= {{limits.{known_support}}} AND n3 <= {{limits.{known_share}}} * l3, n3 <= {{limits.{exact}}} * l3) THEN 'trigram' END
        WHEN l2 >= {{limits.{support}}} OR n2 >= {{limits.{support}}}
            THEN CASE WHEN IF(known, {known_bigrams} AND l2 >= {{limits.{known_support}}} AND n2 <= {{limits.{known_share}}} * l2, n2 <= {{limits.{exact}}} * l2) THEN 'bigram' END
        WHEN NOT known AND l1 >= {{limits.word_support}} AND n1 <= {{limits.{exact}}} * l1 THEN 'word' END"""


def verdicts(grams: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row ``(a, b, w, dotted, test, hinted)`` for each trigram that ends some text, without or with a full stop.

    ``test`` names what finds it cut, or is null; ``hinted`` tells whether it counts as cut once something else hints at it.
    The occurrence at hand is left out of the counts it is judged by. Of words longer than BEGINNING letters
    only those beginnings are counted whose length some text's last word has, as no other can be asked for.
    """
    spark, sums = grams.sparkSession, ", ".join(f"sum({n}) AS {n}" for n in ("n_in", "n_mark", "n_dot", "n_end", "n_stop"))
    longest = "(SELECT coalesce(collect_set(length(w)), array()) FROM {grams} WHERE n_end + n_stop > 0 AND length(w) > {most})"

    def longer(keys: str, n: str, source: str) -> str:
        """So many occurrences of longer words begin with w, in the context of the keys."""
        return f"""
            SELECT {keys} substr(w, 1, k) AS w, sum(n) AS n
            FROM (SELECT {keys} w, n, explode(concat(sequence(1, least({BEGINNING}, length(w) - 1)), filter(lengths, k -> k < length(w)))) AS k
                  FROM (SELECT {keys} w, {n} AS n, {longest} AS lengths FROM {source} WHERE length(w) >= 2 AND w RLIKE r'^\\p{{{{L}}}}'))
            GROUP BY {keys} substr(w, 1, k)"""

    every = "n_in + n_mark + n_dot + n_end + n_stop"
    # counts of bigrams and of words are read by several joins each: written once
    pairs = materialise(spark.sql(f"SELECT b, w, {sums} FROM {{grams}} GROUP BY b, w", grams=grams), "bigrams")
    # contexts: a phrase that many owners give whole ("both … and") is one of them, however often it ends there
    contexts = "count(*) AS contexts, count_if(n_mark + n_end + n_stop > 0) AS ended"
    words = spark.sql(f"SELECT w, {sums}, {contexts} FROM {{pairs}} WHERE b <> '^' GROUP BY w", pairs=pairs)
    beginnings = spark.sql(longer("", "n_in + n_mark + n_dot", "{words}"), words=words, grams=grams, most=BEGINNING)
    words = materialise(words.join(beginnings.withColumnRenamed("n", "l1"), "w", "full"), "words")
    ended = "{t}.n_mark + {t}.n_end + {t}.n_stop + IF(g.dotted, {t}.n_dot, 0) - 1"
    total = "{t}.n_in + {t}.n_mark + {t}.n_dot + {t}.n_end + {t}.n_stop - 1"
    # the few words that many contexts end with (",") meet a broadcast; elsewhere their rows are spread over keys that no word has
    word = ", ".join(f"IF(g.hot, h.{c}, u.{c}) AS {c}" for c in ("n_in", "n_mark", "n_dot", "n_end", "n_stop", "l1", "contexts", "ended"))
    query = rf"""
        WITH finals AS (SELECT *, explode(array(false, true)) AS dotted FROM {{grams}} WHERE n_end + n_stop > 0),
        hot AS (SELECT w FROM (SELECT w, count(*) AS n FROM {{grams}} WHERE n_end + n_stop > 0 GROUP BY w)
                WHERE n >= 10000 AND n * 256 >= (SELECT count(*) FROM {{grams}} WHERE n_end + n_stop > 0)),
        of_word AS (
            SELECT g.*, struct({word}) AS u
            FROM (SELECT /*+ BROADCAST(hot) */ finals.*, hot.w IS NOT NULL AS hot FROM finals LEFT JOIN hot ON hot.w = finals.w WHERE IF(dotted, n_stop, n_end) > 0) g
            LEFT JOIN {{words}} u ON u.w = IF(g.hot, concat(chr(0), pmod(hash(g.a, g.b), 64)), g.w)
            LEFT JOIN (SELECT /*+ BROADCAST(hot) */ v.* FROM {{words}} v LEFT SEMI JOIN hot ON hot.w = v.w) h ON h.w = g.w AND g.hot)
            SELECT g.a, g.b, g.w, g.dotted, g.w RLIKE r'^[\p{{{{L}}}}\p{{{{N}}}}]' AS is_word,
                   {ended.format(t="g")} AS e3, {total.format(t="g")} AS n3, g.n_dot AS dot3, g.n_stop - 1 AS stop3,
                   {ended.format(t="p")} AS e2, {total.format(t="p")} AS n2,
                   coalesce({total.format(t="g.u")}, 0) AS n1,
                   coalesce(g.u.ended - IF(p.n_mark + p.n_end + p.n_stop = 1, 1, 0), 0) AS e1, coalesce(g.u.contexts - IF({total.format(t="p")} = 0, 1, 0), 0) AS c1,
                   coalesce(g.u.n_end + g.u.n_stop - 1, 0) AS t1, coalesce(g.u.n_in + g.u.n_mark + IF(g.dotted, g.u.n_dot, 0), 0) AS i1, coalesce(g.u.n_dot + g.u.n_stop - 1, 0) AS dot1,
                   coalesce(l3.n, 0) AS l3, coalesce(l2.n, 0) AS l2, coalesce(g.u.l1, 0) AS l1
            FROM of_word g
            JOIN {{pairs}} p ON p.b = g.b AND p.w = g.w
            LEFT JOIN ({longer("a, b,", every, "{grams}")}) l3 ON l3.a = g.a AND l3.b = g.b AND l3.w = g.w
            LEFT JOIN ({longer("b,", every, "{pairs}")}) l2 ON l2.b = g.b AND l2.w = g.w"""
    # written, as the tests below name each count many times
    counts = materialise(spark.sql(query, grams=grams, pairs=pairs, words=words, most=BEGINNING), "counts")
    query = f"""
        WITH shares AS (
            SELECT *, i1 >= {limits.known_inside} AND (i1 > {limits.unknown_share} * l1 OR dotted AND dot1 >= {limits.known_inside}) AS known,
                   (e2 + {limits.prior} * (e1 + 0.5) / (c1 + 1)) / (n2 + {limits.prior}) AS s2 FROM {{counts}}),
        tests AS (
            SELECT *, {_broken("support", "exact_share", "known_support", "known_share", "false").format(limits=limits)} AS broken,
                   {_broken("hinted_support", "hinted_exact_share", "hinted_known_support", "hinted_known_share", "true").format(limits=limits)} AS broken_if_hinted,
                   CASE WHEN dotted THEN dot3 >= {limits.known_support} AND stop3 <= {limits.known_share} * dot3
                        WHEN NOT is_word THEN n1 >= {limits.word_support} AND t1 < {limits.terminal_share} * n1
                        ELSE n1 + n2 + n3 >= {limits.word_support} AND (e3 + {limits.prior} * s2) / (n3 + {limits.prior}) < {limits.terminal_share} END AS open_end
            FROM shares)
        SELECT a, b, w, dotted, IF(open_end, 'end', broken) AS test,
               open_end OR broken IS NOT NULL OR broken_if_hinted IS NOT NULL
               OR (NOT dotted AND is_word AND n1 + n2 + n3 >= {limits.word_support} AND (e3 + {limits.prior} * s2) / (n3 + {limits.prior}) < {limits.hinted_terminal_share}) AS hinted
        FROM tests"""
    return spark.sql(query, counts=counts)


def judged_texts(units: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``(text, test, hinted)``: the distinct texts of ``units (owner, text)`` that are cut, or would be with a hint.

    ``test`` is null for texts that are cut only if something hints at it. Null,
    empty and blank texts are not cut. A text that ends in a replacement character or in half of a
    surrogate pair breaks off inside a character and is cut: test ``character``. Repeated pairs make no difference.
    """
    units = materialise(units.where("text is not null").select(F.col("owner").cast("string").alias("owner"), "text").distinct(), "units")
    grams = materialise(trigrams(units.select("text")), "trigrams")
    found = verdicts(grams, limits).where("test is not null or hinted")
    # the last trigram of each text, written: a filter on it would else be tried on every row below the distinct
    texts = materialise(units.select("text").distinct(), "texts")
    ends = materialise(_tokens(texts).select("text", "dotted", F.slice("toks", -3, 3).alias("last"), F.endswith("body", F.lit("\ufffd")).alias("in_char")), "ends")
    return ends.sparkSession.sql(
        """
        SELECT t.text, f.test, f.hinted FROM (SELECT text, dotted, get(last, 0) AS a, get(last, 1) AS b, get(last, 2) AS w FROM {ends} WHERE NOT in_char AND size(last) = 3) t
        JOIN {found} f ON f.a = t.a AND f.b = t.b AND f.w = t.w AND f.dotted = t.dotted
        UNION ALL
        SELECT text, 'character' AS test, true AS hinted FROM {ends} WHERE in_char
        """,
        ends=ends,
        found=found,
    )


def find_truncated(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows ``(tab, row_id, source, test)`` whose text is cut, of ``rows (tab, row_id, source, owner, text)``."""
    cut = materialise(judged_texts(rows.select("owner", "text"), limits).where("test is not null").select("text", "test"), "cut")
    texts = rows.where("text is not null")
    found = spread_join(texts, cut.select("text", "test"), ["text"], "inner", hot_hashes(texts.select("text", F.lit(1).alias("n")), ["text"]))
    return found.select("tab", "row_id", "source", "test")


def truncation_rates(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per table and source: records with a text, cut records and their share."""
    total = rows.where("text is not null").groupBy("tab", "source").agg(F.count(F.lit(1)).alias("n_texts"))
    cut = find_truncated(rows, limits).groupBy("tab", "source").agg(F.count(F.lit(1)).alias("n_cut"))
    same = (total["tab"] == cut["tab"]) & total["source"].eqNullSafe(cut["source"])
    n_cut = F.coalesce(cut["n_cut"], F.lit(0))
    return total.join(cut, same, "left").select(total["tab"], total["source"], "n_texts", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_texts"), 6).alias("cut_share"))
