"""Inflected forms of regular classes by rule: entries meet a small table of endings in a broadcast join.

The table is made from the grammar's parts (theme, tense sign, personal ending), not listed form by form.
An entry has one class, so two of its forms are equal only if their endings are: readings are merged per class and
ending in the table, on the driver. Spreading an entry to its hundred forms then is one projection
after the join, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions.normalize import letters
from glossaria.operators.inflection import merged
from glossaria.operators.skew import spread

# Noun endings by declension; per case the singular and the plural ending.
CASES = "nom gen dat acc abl voc".split()
NOUNS = {
    "n1": ("f", "a ae ae am a a", "ae arum is as is ae"),
    "n2m": ("m", "us i o um o e", "i orum is os is i"),
    "n2n": ("n", "um i o um o um", "a orum is a is a"),
    "n3": ("c", "is is i em e is", "es um ibus es ibus es"),
}
# Personal endings, and per conjugation the present and future where they are no mere theme and ending.
ACTIVE, PASSIVE = "m s t mus tis nt".split(), "r ris tur mur mini ntur".split()
PRESENT = {
    "v1": ("o as at amus atis ant", "or aris atur amur amini antur"),
    "v2": ("eo es et emus etis ent", "eor eris etur emur emini entur"),
    "v4": ("io is it imus itis iunt", "ior iris itur imur imini iuntur"),
}
FUTURE = {
    "v1": ("abo abis abit abimus abitis abunt", "abor aberis abitur abimur abimini abuntur"),
    "v2": ("ebo ebis ebit ebimus ebitis ebunt", "ebor eberis ebitur ebimur ebimini ebuntur"),
    "v4": ("iam ies iet iemus ietis ient", "iar ieris ietur iemur iemini ientur"),
}
# Theme before the signs of the imperfect, the subjunctives, the participle and the perfect stems.
THEMES = {"v1": ("aba", "e", "are", "ans", "av", "at"), "v2": ("eba", "ea", "ere", "ens", "u", "it"), "v4": ("ieba", "ia", "ire", "iens", "iv", "it")}
PERFECT = {"perf ind": "i isti it imus istis erunt", "plup ind": "eram eras erat eramus eratis erant", "futp ind": "ero eris erit erimus eritis erint", "perf sub": "erim eris erit erimus eritis erint", "plup sub": "issem isses isset issemus issetis issent"}


def _people() -> list[str]:
    return [f"{p} {n}" for n in "sp" for p in "123"]


def noun_rules() -> list[tuple[str, str, str]]:
    """(class, ending, reading) of nouns; the gender closes the reading."""
    return [(k, e, f"{c} {n} {gender}") for k, (gender, *numbers) in NOUNS.items() for n, endings in zip("sp", numbers, strict=True) for c, e in zip(CASES, endings.split(), strict=True)]


def verb_rules() -> list[tuple[str, str, str]]:
    """(class, ending, reading) of the conjugations; a deponent has the passive forms only."""
    out = []

    def add(kind: str, endings: list[str], tense: str, voice: str, mood: str) -> None:
        out.extend((kind, e, f"{who.split()[0]} {who.split()[1]} {tense} {voice} {mood}") for who, e in zip(_people(), endings, strict=True))

    for k, (impf, sub, inf, part, perf, sup) in THEMES.items():
        for voice, personal, i in (("active", ACTIVE, 0), ("passive", PASSIVE, 1)):
            add(k, PRESENT[k][i].split(), "pres", voice, "ind")
            add(k, FUTURE[k][i].split(), "fut", voice, "ind")
            add(k, [impf + p for p in personal], "impf", voice, "ind")
            add(k, [sub + p for p in personal], "pres", voice, "sub")
            add(k, [inf + p for p in personal], "impf", voice, "sub")
        out += [(k, inf, "0 pres active inf"), (k, inf[:-1] + "i", "0 pres passive inf"), (k, part, "nom s pres active part"), (k, inf[:-2], "2 s pres active imp"), (k, inf[:-2] + "te", "2 p pres active imp")]
        for name, endings in PERFECT.items():
            tense, mood = name.split()
            add(k, [perf + e for e in endings.split()], tense, "active", mood)
        out.append((k, perf + "isse", "0 perf active inf"))
        out += [(k, sup + e, f"{c} {n} {g} perf passive part") for key, g in (("n1", "f"), ("n2m", "m"), ("n2n", "n")) for n, numbers in zip("sp", NOUNS[key][1:], strict=True) for c, e in zip(CASES, numbers.split(), strict=True)]
    out += [("v1dep", e, r) for k, e, r in out if k == "v1" and " passive " in f" {r} "]
    return out


# What the headword line shows of a class, and what of the headword is not stem.
CLASSES = [
    ("v1dep", r", ātus, 1, v\. dep", "or"),
    ("v1", r", 1, v\.", "o"),
    ("v2", r", 2, v\.", "eo"),
    ("v4", r", 4, v\.", "io"),
    ("n1", r", ae, f\.", "a"),
    ("n2m", r", i, m\.", "us"),
    ("n2n", r", i, n\.", "um"),
    ("n3", r", is, ", "is"),
]


def rules_table(spark: SparkSession) -> DataFrame:
    """``(class, ending, cell)``: some hundreds of rows, whatever the data; endings are folded, their readings merged."""
    cells: dict[tuple[str, str], list[str]] = {}
    for kind, ending, reading in noun_rules() + verb_rules():
        cells.setdefault((kind, ending.replace("j", "i").replace("v", "u")), []).append(reading)
    return spark.createDataFrame([(kind, ending, merged(readings)) for (kind, ending), readings in cells.items()], "class string, ending string, cell string")


def stems(entries: DataFrame) -> DataFrame:
    """``(idx, class, stem)`` of ``(idx, headword, body)``, stems folded; entries of no class, or whose headword doesn't fit it, have no forms."""
    rows = spread(entries.select("idx", "headword", F.substring("body", 1, 120).alias("line")), "idx")
    rows = rows.select("idx", "line", letters(F.col("headword")).alias("head"))
    kind, stem = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, ending in reversed(CLASSES):
        fits = F.col("line").rlike(pattern) & F.col("head").endswith(ending)
        kind = F.when(fits, name).otherwise(kind)
        stem = F.when(fits, F.substring("head", F.lit(1), F.length("head") - len(ending))).otherwise(stem)
    return rows.select("idx", kind.alias("class"), F.translate(stem, "jv", "iu").alias("stem")).where("class is not null and length(stem) > 0")


def expand(entries: DataFrame) -> DataFrame:
    """``(idx, class, form, cell)``: every folded form of an entry of 2 to 24 letters with all its readings in one cell."""
    rows = stems(entries).join(F.broadcast(rules_table(entries.sparkSession)), "class")
    return rows.select("idx", "class", F.concat("stem", "ending").alias("form"), "cell").where("length(form) between 2 and 24")
