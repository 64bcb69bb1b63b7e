"""Paradigms by rule, compared with the forms that the lemma map attests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions import normalize as N
from glossaria.operators import inflection as I
from glossaria.operators import paradigms as P
from glossaria.tables import table


def paradigm_expand(spark: SparkSession, sf: str) -> DataFrame:
    return P.expand(table(spark, sf, "entry", "idx", "headword", "body")).select("idx", "form", "cell")


def paradigm_attested(spark: SparkSession, sf: str) -> DataFrame:
    """Per class: forms made by rule, and how many of them the lemma map has."""
    made = P.expand(table(spark, sf, "entry", "idx", "headword", "body")).select("class", "form")
    seen = table(spark, sf, "lemma_map", "form").distinct().select(N.fold(F.col("form")).alias("form")).distinct().withColumn("seen", F.lit(1))
    return made.join(seen, "form", "left").groupBy("class").agg(F.count(F.lit(1)).alias("forms"), F.count("seen").alias("attested"))


def paradigm_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every form the articles imply, by the whole generator; paradigm_expand is the part of it that its SQL has."""
    return I.inflect(table(spark, sf, "entry", "idx", "headword", "body"))


def paradigm_forms_attested(spark: SparkSession, sf: str) -> DataFrame:
    """Per paradigm (headword for the headwords themselves and what several paradigms make): forms of all articles, and how many of them the lemma map has."""
    kind = F.coalesce(F.regexp_replace("kind", r"^(noun \S+|pres \S+|\S+).*$", "$1"), F.lit("headword"))
    made = I.forms_by_kind(table(spark, sf, "entry", "idx", "headword", "body")).select("idx", kind.alias("kind"), "form")
    seen = table(spark, sf, "lemma_map", "form").distinct().select(N.fold(F.col("form")).alias("form")).distinct().withColumn("seen", F.lit(1))
    return made.join(seen, "form", "left").groupBy("kind").agg(F.count(F.lit(1)).alias("forms"), F.count("seen").alias("attested"))


# The grammar once more, written for the comparison alone: it shares no table with the operators.
_RULES = """
    nouns(kind, n, g, endings) AS (VALUES
        ('n1', 's', 'f', 'a ae ae am a a'), ('n1', 'p', 'f', 'ae arum is as is ae'),
        ('n2m', 's', 'm', 'us i o um o e'), ('n2m', 'p', 'm', 'i orum is os is i'),
        ('n2n', 's', 'n', 'um i o um o um'), ('n2n', 'p', 'n', 'a orum is a is a'),
        ('n3', 's', 'c', 'is is i em e is'), ('n3', 'p', 'c', 'es um ibus es ibus es')),
    supines(kind, sup) AS (VALUES ('v1', 'at'), ('v2', 'it'), ('v4', 'it'), ('v1dep', 'at')),
    finite(kind, pre, endings, rest) AS (VALUES
        ('v1', '', 'o as at amus atis ant', 'pres active ind'), ('v1', '', 'or aris atur amur amini antur', 'pres passive ind'),
        ('v2', '', 'eo es et emus etis ent', 'pres active ind'), ('v2', '', 'eor eris etur emur emini entur', 'pres passive ind'),
        ('v4', '', 'io is it imus itis iunt', 'pres active ind'), ('v4', '', 'ior iris itur imur imini iuntur', 'pres passive ind'),
        ('v1', '', 'abo abis abit abimus abitis abunt', 'fut active ind'), ('v1', '', 'abor aberis abitur abimur abimini abuntur', 'fut passive ind'),
        ('v2', '', 'ebo ebis ebit ebimus ebitis ebunt', 'fut active ind'), ('v2', '', 'ebor eberis ebitur ebimur ebimini ebuntur', 'fut passive ind'),
        ('v4', '', 'iam ies iet iemus ietis ient', 'fut active ind'), ('v4', '', 'iar ieris ietur iemur iemini ientur', 'fut passive ind'),
        ('v1', 'aba', 'm s t mus tis nt', 'impf active ind'), ('v1', 'aba', 'r ris tur mur mini ntur', 'impf passive ind'),
        ('v2', 'eba', 'm s t mus tis nt', 'impf active ind'), ('v2', 'eba', 'r ris tur mur mini ntur', 'impf passive ind'),
        ('v4', 'ieba', 'm s t mus tis nt', 'impf active ind'), ('v4', 'ieba', 'r ris tur mur mini ntur', 'impf passive ind'),
        ('v1', '', 'em es et emus etis ent', 'pres active sub'), ('v1', '', 'er eris etur emur emini entur', 'pres passive sub'),
        ('v2', 'ea', 'm s t mus tis nt', 'pres active sub'), ('v2', 'ea', 'r ris tur mur mini ntur', 'pres passive sub'),
        ('v4', 'ia', 'm s t mus tis nt', 'pres active sub'), ('v4', 'ia', 'r ris tur mur mini ntur', 'pres passive sub'),
        ('v1', 'are', 'm s t mus tis nt', 'impf active sub'), ('v1', 'are', 'r ris tur mur mini ntur', 'impf passive sub'),
        ('v2', 'ere', 'm s t mus tis nt', 'impf active sub'), ('v2', 'ere', 'r ris tur mur mini ntur', 'impf passive sub'),
        ('v4', 'ire', 'm s t mus tis nt', 'impf active sub'), ('v4', 'ire', 'r ris tur mur mini ntur', 'impf passive sub')),
    perfects(kind, pre) AS (VALUES ('v1', 'av'), ('v2', 'u'), ('v4', 'iv')),
    tenses(endings, rest) AS (VALUES ('i isti it imus istis erunt', 'perf active ind'), ('eram eras erat eramus eratis erant', 'plup active ind'), ('ero eris erit erimus eritis erint', 'futp active ind'),
        ('erim eris erit erimus eritis erint', 'perf active sub'), ('issem isses isset issemus issetis issent', 'plup active sub')),
    single(kind, ending, reading) AS (VALUES
        ('v1', 'are', '0 pres active inf'), ('v1', 'ari', '0 pres passive inf'), ('v1', 'ans', 'nom s pres active part'), ('v1', 'a', '2 s pres active imp'), ('v1', 'ate', '2 p pres active imp'), ('v1', 'avisse', '0 perf active inf'),
        ('v2', 'ere', '0 pres active inf'), ('v2', 'eri', '0 pres passive inf'), ('v2', 'ens', 'nom s pres active part'), ('v2', 'e', '2 s pres active imp'), ('v2', 'ete', '2 p pres active imp'), ('v2', 'uisse', '0 perf active inf'),
        ('v4', 'ire', '0 pres active inf'), ('v4', 'iri', '0 pres passive inf'), ('v4', 'iens', 'nom s pres active part'), ('v4', 'i', '2 s pres active imp'), ('v4', 'ite', '2 p pres active imp'), ('v4', 'ivisse', '0 perf active inf')),
    persons AS (
        SELECT kind, pre || unnest(string_split(endings, ' ')) AS ending, unnest(['1 s', '2 s', '3 s', '1 p', '2 p', '3 p']) || ' ' || rest AS reading
        FROM (SELECT * FROM finite UNION ALL SELECT p.kind, p.pre, t.endings, t.rest FROM perfects p CROSS JOIN tenses t) f
        UNION ALL SELECT * FROM single),
    cases AS (SELECT kind, n, g, unnest(string_split(endings, ' ')) AS ending, unnest(['nom', 'gen', 'dat', 'acc', 'abl', 'voc']) AS c FROM nouns),
    rules AS (
        SELECT * FROM persons UNION ALL SELECT 'v1dep', ending, reading FROM persons WHERE kind = 'v1' AND reading LIKE '% passive %'
        UNION ALL SELECT kind, ending, c || ' ' || n || ' ' || g FROM cases
        UNION ALL SELECT s.kind, s.sup || c.ending, c.c || ' ' || c.n || ' ' || c.g || ' perf passive part' FROM supines s JOIN cases c ON c.kind <> 'n3')"""
_FORMS = f"""
    WITH {_RULES},
    stems AS (
        SELECT idx, kind, translate(left(h, length(h) - cut), 'jv', 'iu') AS stem FROM (
            SELECT idx, h, CASE WHEN regexp_matches(line, ', ātus, 1, v\\. dep') AND h LIKE '%or' THEN 'v1dep' WHEN regexp_matches(line, ', 1, v\\.') AND h LIKE '%o' THEN 'v1'
                WHEN regexp_matches(line, ', 2, v\\.') AND h LIKE '%eo' THEN 'v2' WHEN regexp_matches(line, ', 4, v\\.') AND h LIKE '%io' THEN 'v4'
                WHEN regexp_matches(line, ', ae, f\\.') AND h LIKE '%a' THEN 'n1' WHEN regexp_matches(line, ', i, m\\.') AND h LIKE '%us' THEN 'n2m'
                WHEN regexp_matches(line, ', i, n\\.') AND h LIKE '%um' THEN 'n2n' WHEN line LIKE '%, is, %' AND h LIKE '%is' THEN 'n3' END AS kind
            FROM (SELECT idx, substr(body, 1, 120) AS line, {N.sql_letters("headword")} AS h FROM entry) e) k
        JOIN (VALUES ('v1dep', 2), ('v1', 1), ('v2', 2), ('v4', 2), ('n1', 1), ('n2m', 2), ('n2n', 2), ('n3', 2)) c(name, cut) ON c.name = k.kind WHERE length(h) > cut)
    SELECT DISTINCT idx, s.kind AS class, stem || translate(ending, 'jv', 'iu') AS form, reading FROM stems s JOIN rules r ON s.kind = r.kind WHERE length(stem || ending) BETWEEN 2 AND 24"""
QUERIES = {"paradigm_expand": paradigm_expand, "paradigm_attested": paradigm_attested, "paradigm_forms": paradigm_forms, "paradigm_forms_attested": paradigm_forms_attested}
ORACLE = {
    "paradigm_expand": f"SELECT idx, form, string_agg(reading, '|' ORDER BY reading) AS cell FROM ({_FORMS}) f GROUP BY idx, form",
    "paradigm_attested": f"""
        SELECT class, count(*) AS forms, count(seen) AS attested FROM (SELECT DISTINCT idx, class, form FROM ({_FORMS}) f) x
        LEFT JOIN (SELECT DISTINCT {N.sql_fold('form')} AS form, 1 AS seen FROM (SELECT DISTINCT form FROM lemma_map) l) k ON x.form = k.form GROUP BY class""",
}
