"""Keys of comparison for Latin-script text, as plain column expressions.

Spark has no normalisation function. The fold of accents is one ``translate`` whose table is made from
the Unicode database: every character of the basic plane that decomposes to one ASCII letter. Letters
that stand for two are replaced before. Combining marks are deleted. The same table serves the SQL that
results are compared with.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that stand for several, or for one that decomposition does not give.
PAIRS = {"æ": "ae", "œ": "oe", "ß": "ss", "ð": "d", "þ": "th", "ø": "o", "đ": "d", "ł": "l", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ĳ": "ij", "ў": "y"}


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Two strings of equal length: lower-case characters, and the ASCII letter each decomposes to."""
    source, target = [], []
    for code in range(0xAA, 0xFFFF):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or char != char.lower():
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower()
        if len(base) == 1 and base.isascii() and base.isalpha() and char not in PAIRS:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def strip_accents(column: Column) -> Column:
    """Lower case without accents; ligatures as letter pairs. Null stays null."""
    out = F.lower(column)
    for char, pair in PAIRS.items():
        out = F.replace(out, F.lit(char), F.lit(pair))
    return F.regexp_replace(F.translate(out, *accent_table()), r"\p{M}+", "")


def letters(column: Column) -> Column:
    """Only a-z of the unaccented text."""
    return F.regexp_replace(strip_accents(column), "[^a-z]+", "")


def fold(column: Column) -> Column:
    """As :func:`letters`, with j as i and v as u: spellings that differ in these only compare equal."""
    return F.translate(letters(column), "jv", "iu")


def plain(column: Column) -> Column:
    """As :func:`letters`, keeping hyphens."""
    return F.regexp_replace(strip_accents(column), "[^a-z-]+", "")


def words_key(column: Column) -> Column:
    """Unaccented letters and digits with single spaces between the words: texts that differ in marks only compare equal."""
    return F.trim(F.regexp_replace(strip_accents(column), r"[^\p{L}\p{N}]+", " "))


def split_number(column: Column) -> tuple[Column, Column]:
    """A key and its trailing number (null where there is none)."""
    return F.regexp_replace(column, "[0-9]+$", ""), F.nullif(F.regexp_extract(column, "([0-9]+)$", 1), F.lit("")).cast("int")


def sql_strip_accents(expr: str) -> str:
    """The same fold in SQL, for comparison."""
    out = f"lower({expr})"
    for char, pair in PAIRS.items():
        out = f"replace({out}, '{char}', '{pair}')"
    source, target = accent_table()
    return f"regexp_replace(translate({out}, '{source}', '{target}'), '\\p{{M}}+', '', 'g')"


def sql_letters(expr: str) -> str:
    return f"regexp_replace({sql_strip_accents(expr)}, '[^a-z]+', '', 'g')"


def sql_fold(expr: str) -> str:
    return f"translate({sql_letters(expr)}, 'jv', 'iu')"


def sql_plain(expr: str) -> str:
    return f"regexp_replace({sql_strip_accents(expr)}, '[^a-z-]+', '', 'g')"
