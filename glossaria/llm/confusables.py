"""One consistent form for text that looks the same but is stored as other characters.

Compatibility normalisation in composed form, mapped white space and hyphens, look-alike letters of
other scripts, and removal of default-ignorable characters. Letter case and vowel marks can be kept
or folded. Rows whose value is visibly consistent already are settled by one pattern in the JVM; the
others go to Python in Arrow batches, where each distinct value of a batch is normalised once.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that are drawn like Latin letters.
LOOK_ALIKE = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲⅽ", "d": "ԁɗⅾ", "e": "еҽ", "f": "ғẝ", "g": "ɡցᶃ", "h": "һհ", "i": "іιı",
    "j": "јϳ", "k": "кκ", "l": "ӏ", "m": "м", "n": "ոռ", "o": "оοօ", "p": "рρ", "q": "ԛգ", "r": "гᴦ",
    "s": "ѕꜱ", "t": "тτ", "u": "սυ", "v": "νѵ", "w": "ԝѡա", "x": "хχ", "y": "уγү", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "D": "Ꭰ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ",
    "L": "Ꮮ", "M": "МΜ", "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "R": "Ꭱ", "S": "ЅՏ", "T": "ТΤ", "U": "Ս", "V": "Ѵ", "W": "Ԝ",
    "X": "ХΧ", "Y": "УΥҮ", "Z": "Ζ", "æ": "ӕ", "Æ": "Ӕ",
}
# Code points drawn as a hyphen.
HYPHENS = [0x2010, 0x2011, 0x2012, 0x2013, 0x2043, 0x2212, 0xFE63, 0xFF0D, 0x02D7]
# Ranges of default-ignorable code points (Unicode, DerivedCoreProperties) and format characters drawn as nothing.
IGNORABLE = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8),
    (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
# Code points drawn as white space that the white space class leaves out.
BLANK = [0x2800, 0x0085]

_to_latin = {ord(x): latin for latin, others in LOOK_ALIKE.items() for x in others}
_hyphens = dict.fromkeys(HYPHENS, "-")
_ignorable = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in IGNORABLE) + "]")
_space = re.compile(r"[\s" + "".join(map(chr, BLANK)) + "]+")
#: Consistent as it stands: Latin letters, marks only where no composed letter exists, single inner spaces.
_LETTER = "[A-Za-z0-9æœÆŒāăēĕīĭōŏūŭȳĀĂĒĔĪĬŌŎŪŬȲ]"
_DOUBLE = "[āēīōūȳĀĒĪŌŪȲ]\\u0306|[ăĕĭŏŭĂĔĬŎŬ]\\u0304|[yY]\\u0306"
_UNIT = f"(?:{_DOUBLE}|{_LETTER}|[-.,;:'!?()])++"
#: Ends with \z: in Java $ also stands before a final line break.
CONSISTENT = f"^(?:{_UNIT}(?: {_UNIT})*+)?\\z"
#: Longer values go to Python: the pattern is for words and phrases.
LONGEST_SETTLED = 200


def _all_greek(text: str) -> bool:
    letters = [c for c in unicodedata.normalize("NFD", text) if c.isalpha()]
    return bool(letters) and all("Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" for c in letters) and not all(c in _to_latin_letters for c in map(ord, letters))


_to_latin_letters = set(_to_latin)


@lru_cache(maxsize=1 << 16)
def consistent_form(text: str | None, fold_case: bool = False, keep_greek: bool = True) -> str | None:
    """The one form of ``text``; see :func:`consistent`."""
    if text is None:
        return None
    out = _space.sub(" ", _ignorable.sub("", text)).strip(" ").translate(_hyphens)
    if keep_greek and _all_greek(out):
        out = unicodedata.normalize("NFC", out)
    else:
        out = unicodedata.normalize("NFKD", out.translate(_to_latin)).translate(_to_latin)
        # decomposition can bring forth spaces, hyphens and ignorable characters
        out = _space.sub(" ", _ignorable.sub("", out)).strip(" ").translate(_hyphens)
        out = unicodedata.normalize("NFC", out)
    if fold_case:
        out = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", out).casefold())
    return out


def _vectorised(fold_case: bool, keep_greek: bool):  # noqa: ANN202
    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(values)
        done = [consistent_form(v, fold_case, keep_greek) for v in distinct]
        return pd.Series([done[c] if c >= 0 else None for c in codes], dtype=object)

    return run


def consistent(column: Column, fold_case: bool = False, keep_greek: bool = True) -> Column:
    """The consistent form of a text column.

    Latin letters; an accented letter as one character where it exists, otherwise the letter followed by
    the remaining mark; U+0020 between words and none at the ends; '-' as hyphen; nothing invisible.
    With ``keep_greek`` a value written in Greek throughout keeps its letters. With ``fold_case`` the value
    is case-folded as well. Null stays null, the empty string stays empty, and a value of white space
    or invisible characters only becomes empty. Applying it twice changes nothing.
    """
    settled = (F.length(column) <= LONGEST_SETTLED) & column.rlike(r"^[a-z]*\z" if fold_case else CONSISTENT)
    return F.when(column.isNull() | settled, column).otherwise(_vectorised(fold_case, keep_greek)(F.when(~settled, column)))
