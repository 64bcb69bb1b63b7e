"""Definitions of names and outlines of senses, from articles written out with their markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions import names as P
from glossaria.tables import table


def marked() -> Column:
    """The body as markup: the headword line, then a sense per part, its text in italics."""
    body = F.col("body")
    line = F.regexp_extract(body, r"^(.*?(?:[mfn]|comm|dep|a)\. )", 1)
    senses = F.split(F.substring(body, F.length(line) + 1, F.length(body)), "; ")
    shown = F.transform(senses, lambda s, i: F.concat(F.lit('<sense level="'), F.when(s.rlike("^[A-Z][a-z]+[.],"), "2").otherwise("1"), F.lit('" n="'), (i + 1).cast("string"), F.lit('"><hi rend="ital">'), s, F.lit("</hi></sense>")))
    return F.concat(line, F.array_join(shown, ""))


def name_glosses(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entry", "idx", "headword", "body").where(P.is_name(F.col("headword"))).withColumn("xml", marked())
    e = e.withColumn("definition", P.name_definition(F.col("xml"), F.col("headword")))
    return e.select("idx", "definition", P.name_clean(F.col("definition"), F.col("headword")).alias("gloss"))


def sense_lines(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entry", "idx", "body").withColumn("xml", marked())
    return e.select("idx", P.sense_lines(F.col("xml")).alias("outline"))


QUERIES = {"name_glosses": name_glosses, "sense_lines": sense_lines}
_CLEAN = r"trim(regexp_replace({x}, '[\s\x{{00A0}}]+', ' ', 'g'))"
_CUM = "list_filter({l}, lambda x, i: {used} + list_sum(list_transform({l}[1:i], lambda y: length(y) + 1)) - 1 <= 900)"
ORACLE = {
    "sense_lines": rf"""
        WITH l AS (SELECT idx, body, regexp_extract(body, '^(.*?(?:[mfn]|comm|dep|a)\. )', 1) AS line FROM entry),
        s AS (SELECT idx, substr(regexp_replace({_CLEAN.format(x="regexp_replace(line, '[(][^()]*[)]', ' ', 'g')")}, '^[ ,;:]+|[ ,;:]+$', '', 'g'), 1, 120) AS head, list_transform(string_split(substr(body, length(line) + 1), '; '), lambda t, i: {{'n': i, 'raw': t}}) AS parts FROM l),
        t AS (SELECT idx, head, list_filter(list_transform(parts, lambda p: {{'two': regexp_matches(p.raw, '^[A-Z][a-z]+[.],'), 'n': p.n, 't': regexp_replace({_CLEAN.format(x=r"regexp_replace(p.raw, '([:;,]\s*){{2,}}', ' ', 'g')")}, '^[ ,;:.]+|[ ,;:.]+$', '', 'g')}}),
                  lambda p: p.t <> '' AND NOT regexp_matches(p.t, '^([a-z]{{1,7}}\.\s*)+$')) AS lines FROM s),
        u AS (SELECT idx, head, list_transform(list_filter(lines, lambda p: NOT p.two), lambda p: p.n || '. ' || substr(p.t, 1, 70)) AS one, list_transform(list_filter(lines, lambda p: p.two), lambda p: p.n || '. ' || substr(p.t, 1, 70)) AS two FROM t),
        k AS (SELECT idx, head, two, {_CUM.format(l='one', used='length(head)')} AS one FROM u),
        m AS (SELECT idx, head, one, two, length(head) + coalesce(list_sum(list_transform(one, lambda y: length(y) + 1)), 0) AS used FROM k)
        SELECT idx, array_to_string(list_concat([head], one, {_CUM.format(l='two', used='used')}), chr(10)) AS outline FROM m""",
}
