"""Broken prompt and response pairs, each with the type of its defect.

Truncated answers are found by what hints at them, then by phrases:

1. Responses are sorted by text and neighbours' common prefixes compared: a response that the next one in order goes on
   from inside a word is a shortened version of it, or happens to be the beginning of another word.
2. Lengths at which a run's responses pile up are its length limits; a response of such a length may have been cut there.
3. The phrase statistics of :mod:`truncation` tell, with a lower threshold for what 1 or 2 hint at, whether a response
   stops in a word or where its phrase cannot end.

Then come the rules for copies of the prompt, refusals and answers in another language. A key may hold any part of
the rows: texts, articles and words that do are salted, and a text is judged once however often it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaria.functions.normalize import words_key
from glossaria.llm.truncation import Limits, judged_texts
from glossaria.operators.skew import hot_hashes, lookup_join, spread_join
from glossaria.workspace import materialise

# How a refusal begins, the verbs of what is refused, and whole answers that refuse.
_DECLINES = (
    r"(?:as an? (?:ai|language)\b.*|i m sorry.*|i am sorry.*|sorry (?:but )?i .*|unfortunately .*|i (?:can ?not|can t|could not|couldn t) \w+ .*"
    r"|i (?:am|m) (?:not able|unable) to .*|(?:we are |it is )?unable to \w+ (?:the|a|an|this|that|which|with|without|any)\b.*|i (?:won t|will not) be able to .*"
    r"|(?:it is |it s )?(?:not|im) ?possible to .*|i must decline.*|i (?:have to |must )?(?:refuse|decline) to .*|i (?:do not|don t) (?:know|understand|have|see|find)\b.*|cannot \w+ (?:the|a|an|this|which|with|without)\b.*)"
)
_NOTHING_SAID = (
    r"(?:none|n a|null|unknown|unclear|no idea|not (?:sure|given|stated|available|determinable|enough|specified|clear|found)\b.*|insufficient .*|unknown not .*"
    r"|no (?:\w+ )?(?:gloss|meaning|definition|answer|translation|sense|information|entry|result)s?\b(?: .*)?|there (?:is|are) no .*"
    r"|the (?:article|entry|text|excerpt|dictionary|source) (?:gives|has|contains|offers|does|is|provides|states)\b.*(?:no|not|too|only)\b.*|not determinable.*|cannot be (?:determined|given|glossed).*)"
)


#: Sorts behind every other character.
_LAST = "\U0010ffff"


def shortened(texts: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(text, longer, common)`` for each distinct text that another one goes on from; inside a word, if any does.

    In the order used, letters come before all other characters, so what continues a text inside a word stands right
    behind it, and the next text alone decides. The order is made by range partitioning and a sort within partitions;
    each task also hands out the first and last text it saw, and these meet across partitions (one pair each).
    """
    spark = texts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.regexp_replace("text", r"([^\p{L}])", f"{_LAST}$1")

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, before, columns = TaskContext.get().partitionId(), None, ["part", "place", "text", "longer"]
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if before is None:
                    rows.append((part, "first", text, None))
                elif text.startswith(before):
                    rows.append((part, "within", before, text))
                before = text
            yield pd.DataFrame(rows, columns=columns)
        if before is not None:
            yield pd.DataFrame([(part, "last", before, None)], columns=columns)

    ordered = texts.select("text").where("text is not null and text != ''").distinct().repartitionByRange(n, key).sortWithinPartitions(key)
    found = materialise(ordered.mapInPandas(neighbours, "part int, place string, text string, longer string"), "neighbours")
    ends = found.where("place != 'within'").groupBy("part").agg(*[F.max(F.when(F.col("place") == p, F.col("text"))).alias(p) for p in ("first", "last")])
    across = ends.select(F.col("last").alias("text"), F.lead("first").over(Window.orderBy("part")).alias("longer")).where(F.startswith("longer", F.col("text")))
    return found.where("place = 'within'").select("text", "longer").unionByName(across).select("text", "longer", F.length("text").alias("common"))


def length_limits(answers: DataFrame, factor: float = 4.0, least: int = 20) -> DataFrame:
    """``(run, n_chars)``: lengths at which a run has ``factor`` times what neighbouring lengths have on average."""
    lengths = answers.where("text is not null").groupBy("run", F.length("text").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))
    near = Window.partitionBy("run").orderBy("n_chars").rangeBetween(-4, 4)
    around = (F.sum("n").over(near) - F.col("n")) / 8
    return lengths.withColumn("around", around).where((F.col("n") >= least) & (F.col("n") > factor * F.col("around"))).select("run", "n_chars")


def english_words(glosses: DataFrame, least_owners: int = 3) -> DataFrame:
    """Words ``(word)`` of reference glosses ``(key, owners)`` that glosses of at least ``least_owners`` owners use."""
    words = glosses.select("owners", F.explode(F.array_distinct(F.split("key", " "))).alias("word"))
    return words.where("word != ''").groupBy("word").agg(F.sum("owners").alias("n")).where(F.col("n") >= least_owners).select("word")


# Frequent English words that a list of short glosses may lack.
COMMON_ENGLISH = (
    "a an the of to in on at by for from with without and or but not no nor as is are was were be been being it its this that these those he she they we you i his her their our your my"
    " who whom whose which what when where why how one two three four five six seven eight nine ten some any each every all both either neither other another such same so than then there here"
    " have has had do does did can could may might must shall should will would into onto over under out up down off again also only very more most less least between among through during before after about against"
).split()


def english_share(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(text, known, total)``: how many words of each distinct ``(text, key)`` are in the vocabulary; a word counts as often as it stands."""
    words = texts.select("text", F.explode(F.split("key", " ")).alias("word")).where("word != '' and not word rlike '^[0-9]+$'")
    known = vocabulary.unionByName(vocabulary.sparkSession.createDataFrame([(w,) for w in COMMON_ENGLISH], "word string")).distinct().withColumn("known", F.lit(1))
    return lookup_join(words, known, "word").groupBy("text").agg(F.count("known").alias("known"), F.count(F.lit(1)).alias("total"))


def _instructions(prompts: DataFrame, most: int, least_words: int) -> list[str]:
    """The literal parts of the instructions, normalised; prompts are a small table of checked size."""
    parts = prompts.where("body is not null").select(F.explode(F.split("body", r"\{[A-Z]+\}|\n")).alias("part")).select(words_key(F.col("part")).alias("part")).distinct()
    rows = [r[0] for r in parts.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} instructions")
    return sorted(p for p in rows if len(p.split()) >= least_words)


def cut_answers(answers: DataFrame, judged: DataFrame, pool: DataFrame) -> DataFrame:
    """``(text, by)`` of the distinct answers ``(text, run, key, n)`` that are cut; by is 'length limit', 'neighbour' or 'phrase'.

    ``judged`` are the texts that phrases find cut, or would with a hint; ``pool (text)`` are the texts that neighbours are
    looked for in. A hint is a length limit of a run that gave the answer, or a neighbour that continues it inside a word.
    """
    mid_word = F.substring("longer", F.col("common") + 1, F.lit(1)).rlike(r"\p{L}") & F.substring("text", -1, 1).rlike(r"\p{L}")
    neighbours = shortened(pool).where(mid_word).select("text", F.lit("neighbour").alias("by"))
    by_limit = answers.withColumn("n_chars", F.length("text")).join(length_limits(answers), ["run", "n_chars"], "left_semi").select("text", F.lit("length limit").alias("by"))
    hints = neighbours.unionByName(by_limit).groupBy("text").agg(F.min("by").alias("by"))
    rows = judged.join(answers.select("text").distinct(), "text", "left_semi").join(hints, "text", "left")
    return rows.where("test is not null or by is not null").select("text", F.coalesce("by", F.lit("phrase")).alias("by"))


def find_defects(
    answers: DataFrame, articles: DataFrame, prompts: DataFrame, glosses: DataFrame, limits: Limits = Limits(), least_share: float = 0.5, most_prompts: int = 10_000, least_words: int = 4
) -> DataFrame:
    """One row ``(rec_id, defect, by)`` for each defective answer; ``by`` says what found a truncated one.

    ``answers (rec_id, idx, text, run)``, ``articles (idx, headword, body)`` unique in idx, ``prompts (body)``,
    ``glosses (owner, text)`` of good glosses for phrase and word statistics. Defects, the first that holds:
    'empty' (null, or no letter and no digit), 'copy' (the headword, once or repeated; the beginning of the
    article from the headword on; the wording of an instruction), 'refusal', 'truncated', 'language' (fewer than
    ``least_share`` of the words are English, which is what glosses that are not cut use). An answer about an article that
    does not exist cannot copy it. Repeated lines are judged once and each reported. Equal answers to different
    articles are judged for each article. Tables may be empty; other columns are never read.
    """
    rows = answers.select("rec_id", F.coalesce(F.col("idx").cast("string"), F.lit("")).alias("idx"), "text", "run")
    says = F.col("text").rlike(r"[\p{L}\p{N}]")
    empty = rows.where(F.col("text").isNull() | ~says).select("rec_id", F.lit("empty").alias("defect"), F.lit(None).cast("string").alias("by"))
    # each step is written: the next ones plan over files, and no step is computed twice
    pairs = materialise(rows.where(says).groupBy("idx", "text", "run").agg(F.count(F.lit(1)).alias("n")).withColumn("key", words_key(F.col("text"))), "answers")
    good = glosses.where("text is not null").groupBy("text").agg(F.count_distinct("owner").alias("owners"), F.count(F.lit(1)).alias("n"))
    good = materialise(good.withColumn("key", words_key(F.col("text"))), "glosses")
    distinct = pairs.select("text", "key").distinct()

    units = glosses.select(F.concat(F.lit("g"), F.col("owner")).alias("owner"), "text").unionByName(pairs.select(F.concat(F.lit("a"), F.col("idx")).alias("owner"), "text"))
    judged = materialise(judged_texts(units, limits), "judged")
    cut = cut_answers(pairs, judged, distinct.select("text").unionByName(good.select("text")))

    known = good.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    refusals = distinct.where(F.col("key").rlike(f"^(?:{_DECLINES}|{_NOTHING_SAID})$")).join(known, "key", "left_anti")
    whole = good.join(judged.where("test is not null").select("text"), "text", "left_anti")
    share = english_share(distinct, english_words(whole))
    foreign = share.where(F.col("known") < least_share * F.col("total"))

    def found(df: DataFrame, turn: int, defect: str, by: Column) -> DataFrame:
        return df.select("text", F.struct(F.lit(turn).alias("turn"), F.lit(defect).alias("defect"), by.cast("string").alias("by")).alias("v"))

    every = found(refusals, 1, "refusal", F.lit(None)).unionByName(found(cut, 2, "truncated", F.col("by"))).unionByName(found(foreign, 3, "language", F.lit(None)))
    verdict = materialise(every.groupBy("text").agg(F.min("v").alias("v")).select("text", "v.defect", "v.by"), "verdicts")
    copied = materialise(_copies(pairs.select("idx", "text", "key").distinct(), articles, _instructions(prompts, most_prompts, least_words), least_words).withColumn("copied", F.lit(True)), "copies")
    hot = hot_hashes(pairs, ["text"])
    told = spread_join(rows.where(says), verdict, ["text"], "left", hot)
    told = spread_join(told, copied, ["text", "idx"], "left", hot_hashes(pairs, ["text", "idx"]))
    defect = F.when(F.col("copied"), "copy").otherwise(F.col("defect"))
    return told.select("rec_id", defect.alias("defect"), F.when(defect == "truncated", F.col("by")).alias("by")).where("defect is not null").unionByName(empty)


def _copies(once: DataFrame, articles: DataFrame, instructions: list[str], least_words: int) -> DataFrame:
    """Those of the answers ``(idx, text, key)`` that give back the headword, the article's beginning or an instruction."""
    seen = articles.select(F.col("idx").cast("string").alias("idx"), F.col("headword"), F.col("body")).where("idx is not null")
    looked = lookup_join(once, seen, "idx").withColumn("head", words_key(F.col("headword"))).withColumn("article", words_key(F.col("body")))
    head = F.length("head") > 0
    apart = [F.concat(F.lit(" "), F.replace(F.col(c), F.lit(" "), F.lit("  ")), F.lit(" ")) for c in ("key", "head")]
    repeats = head & (F.replace(*apart, F.lit("")) == "")
    article = head & F.startswith("key", F.concat("head", F.lit(" "))) & F.startswith("article", F.col("key"))
    asked = F.lit(False)
    for part in instructions:
        begun = F.startswith(F.lit(part), F.col("key")) & (F.size(F.split("key", " ")) >= least_words)
        asked = asked | F.contains("key", F.lit(part)) | begun
    return looked.where((F.col("key") == F.col("head")) | repeats | article | asked).select("idx", "text")
