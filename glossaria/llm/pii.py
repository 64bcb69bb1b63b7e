"""Personal information in free text: found by anchors, widened and checked by local parsers.

One Aho-Corasick automaton finds every literal that can belong to an item: at-signs and their written
forms, the schemes mailto: and tel:, identifier and account cues, digits, street words, listed given names and
the stems of known family names. Around each anchor a deterministic parser widens to the item's bounds and checks
its form. A parser goes as far as the item does: it stops at a character or after a number of words that no
item has, never at a distance. Anchors of one kind whose surroundings overlap are parsed together, so
the cost stays linear in the text and very long texts need no special way.

Identity numbers behind a cue are taken by their form, unless a check letter is wrong or a part is all zeros: a number
that is said to be one is personal even if it was copied wrongly. Without a cue only forms with a check that holds are
taken: bank accounts (mod 97), payment cards (Luhn), eight digits with their letter, and numbers of 15 digits with
their key, besides two letters, three pairs of digits and a letter.

Names: a list of names is never complete. Family names are recognised by stem and ending if both recur in
the listed ones; given names by standing where a given name stands before (or after) a family name. A
family name of any other form is found after a listed given name, if a title, a mailbox or a telephone is next to them.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Item = tuple[int, int, str]

# How an at-sign is written.
AT_SIGNS = ["@", "＠", "[at]", "(at)", "{at}", "<at>", "﹫"]
# Schemes of links to a mailbox and a telephone.
SCHEMES = {"mailto": ["mailto:"], "tel": ["tel:", "callto:", "sms:"]}
# Labels that stand before an identity number.
ID_CUES = [
    "ssn", "social security number", "social security no", "social no", "social number", "sozialversicherungsnummer", "number is", "card", "carte",
    "identity card", "identity number", "identity no", "id card", "id number", "id no", "national id", "personalausweis", "ausweisnummer",
    "passport", "passport no", "passport number", "reisepass", "reisepass nr", "passeport", "pasaporte", "nino", "national insurance no",
    "national insurance number", "ni number", "ni no", "tax id", "tax no", "tax number", "tin", "steuer-id", "steuernummer", "steuer-nr", "idnr", "dni", "nif", "nie",
    "numéro de sécurité sociale", "n° de sécurité sociale", "no de sécurité sociale", "sécurité sociale", "insee", "nir", "matricule",
]
# Labels that stand before the number of an account or a payment card.
ACCOUNT_CUES = ["account number", "account no", "acct no", "bank account", "iban", "kontonummer", "konto-nr", "konto nr", "compte n°", "numéro de compte", "número de cuenta", "card number", "card no", "credit card", "debit card", "kreditkarte", "carte bancaire"]
# Street words after the name, joined to the name, and before the name.
STREET_AFTER = ["Street", "St", "Road", "Rd", "Lane", "Ln", "Avenue", "Ave", "Drive", "Dr", "Way", "Close", "Court", "Ct", "Boulevard", "Blvd", "Place", "Pl", "Square", "Sq", "Terrace", "Crescent", "Gardens", "Grove", "Row", "Hill", "Walk", "Mews"]
STREET_JOINED = ["straße", "strasse", "str.", "weg", "gasse", "allee", "platz", "ufer", "damm", "ring"]
STREET_BEFORE = ["Via", "Viale", "Piazza", "Piazzale", "Corso", "Largo", "Vicolo", "Calle", "Avenida", "Plaza", "Paseo", "Rua", "Carrer"]
STREET_FRENCH = ["rue", "avenue", "boulevard", "place", "chemin", "quai", "impasse", "allée", "cours", "route", "passage"]
# Titles, which are no part of a name, and particles, which are.
TITLES = {"Dr", "Prof", "Mr", "Mrs", "Ms", "Miss", "Sir", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame", "Sig", "Don", "Doña", "Professor", "Doctor", "Signed", "Yours", "Dear", "Liebe", "Lieber", "Cher", "Chère", "From", "Contact", "Present", "Editor", "Reader", "Tel"}
PARTICLES = ["van", "von", "de", "der", "den", "di", "da", "del", "della", "du", "la", "le", "ten", "ter", "zu", "zum", "af", "av", "al", "el", "bin", "ibn"]

_UP = r"[A-ZÀ-ÖØ-ÞĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮİĴĶĹĻĽĿŁŃŅŇŊŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽ]"
_WORD = rf"{_UP}[^\W\d_]+(?:['’]{_UP}?[^\W\d_]+)?"
_NAME = rf"{_WORD}(?:-{_WORD})*"
_LEFT = re.compile(rf"(?<![\w@.+-])((?:{_NAME}(?:[ \xa0]{_UP}\.){{0,2}}|(?:{_UP}\.[ \xa0-]?){{1,3}}))[ \xa0](?:(?:{'|'.join(PARTICLES)})[ \xa0]){{0,2}}$")
_INITIALS = re.compile(rf"^(?:{_UP}\.[ \xa0-]?)+$")
_RIGHT = re.compile(rf",[ \xa0]({_NAME}(?:[ \xa0]{_UP}\.){{0,2}}|(?:{_UP}\.[ \xa0]?){{1,3}})(?![\w@])")
_PARTICLES_LEFT = re.compile(rf"(?<!\w)(?:(?:{'|'.join(PARTICLES)})[ \xa0]){{1,2}}$")
_TOKEN = re.compile(rf"{_NAME}")
# A listed given name and any family name, and the titles and labels before which the two are a person.
_GIVEN_FIRST = re.compile(rf"({_NAME})(?:[ \xa0]{_UP}\.)?[ \xa0](?:(?:{'|'.join(PARTICLES)})[ \xa0]){{0,2}}({_NAME})")
_WEAK_TITLES = {"Don", "From", "Present", "Editor", "Reader", "Tel"}
_TITLE_LEFT = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(TITLES - _WEAK_TITLES))})[.:,]?[ \xa0]\Z")
_NO_FAMILY = TITLES | set(STREET_AFTER) | set(STREET_BEFORE)

_LOCAL = re.compile(r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~.À-ɏ-]")
# A scheme with what may follow it up to a mailbox: that is the user part of a link, no mail address.
_USER_OF_LINK = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/@<>\"]*\Z")
_DOT = r"(?:\.|[ ]?(?:\[dot\]|\(dot\)|\{dot\})[ ]?)"
_DOMAIN = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+", re.I)
# In a link: an at-sign may be written %40, and a number of 7 to 15 digits needs no separators.
_LINKED_MAIL = re.compile(r"[A-Za-z0-9!$'*+/=^_`{|}~.%-]+?(?:@|%40)(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])", re.I)
_LINKED_PHONE = re.compile(r"\+?(?:[(.-]{0,2}\d[).-]{0,2}){6,14}\d(?!\w)(?:;ext=\d{1,5}\b)?", re.I)

_NUMBER = re.compile(r"(?<![\w.])[+(]?\d[\d ().\xa0/-]{5,}\d(?![\d])")
# Within a run: where a group begins; what parts two numbers; a number or date that stands before one; what comes after one.
_GROUP = re.compile(r"\((?=\d)|(?<![\d(])\d")
_APART = re.compile(r"(?:[ \xa0][/-]|/)[ \xa0]*\Z|[ \xa0]{2}\Z")
_STRAY = re.compile(r"[ \xa0]?\(?(?:\d{1,3}|\d{1,4}(?:[/.-]\d{1,4}){1,2})\)?[ \xa0]")
_NEXT = re.compile(r"[ .\xa0]*(?:[/(]|-[ \xa0]|[ \xa0]{2})|[ \xa0]-")
_EXTENSION = re.compile(r"[ ]?(?:ext\.?|x|app\.?|Durchwahl|poste)[ ]?\d{1,5}\b", re.I)
_SEP = r"[ .\xa0/-]?"
# Formats of telephone numbers: North America; Britain; France; Germany; any number with a country code.
_PHONES = [
    re.compile(rf"(?:(?:\+|00)1{_SEP}|1-)?(?:\([2-9]\d\d\)[ ]?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]?\d{{4}}(?!\d)"),
    re.compile(r"(?:\+|00)1[2-9]\d\d[2-9]\d{6}(?!\d)"),
    re.compile(r"(?:(?:\+|00)44[ ]?(?:\(0\)[ ]?)?|\(?0)(?:\d{2}\)?[ ]?\d{4}[ ]?\d{4}|\d{3}\)?[ ]?\d{3}[ ]?\d{4}|\d{4}\)?[ ]?\d{3}[ ]?\d{3})(?!\d)"),
    re.compile(r"(?:(?:\+|00)33[ .]?(?:\(0\)[ ]?)?|0)[1-9](?:[ .-]?\d\d){4}(?!\d)"),
    re.compile(r"(?:(?:\+|00)49[ ]?(?:\(0\)[ ]?)?|\(?0)[1-9]\d{1,4}\)?[ /-][ ]?\d{3,8}(?:[ -]\d{1,5})?(?!\d)"),
    re.compile(r"\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,5}\)?){2,6}(?!\d)"),
]
# Forms of identity and account numbers; the check of each is in _CHECKS.
_FORMS = {
    "insurance": re.compile(r"[A-Z]{2}[ -]?\d{2}[ -]?\d{2}[ -]?\d{2}[ -]?[A-D](?!\w)"),  # two letters, three pairs, a letter
    "iban": re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)"),
    "letter": re.compile(r"\d{2}\.?\d{3}\.?\d{3}[ -]?[A-Z](?!\w)"),  # eight digits and a check letter
    "key": re.compile(r"\d \d\d \d\d \d[\dAB] \d{3} \d{3}(?: \d\d)?(?!\d)|\d{15}(?!\w)"),  # 13 digits in six groups, and their key
    "payment": re.compile(r"[3-6]\d{3}(?:[ -]?\d{4}){3}(?:\d{3})?(?!\w)|3\d{3}[ -]?\d{6}[ -]?\d{5}(?!\w)"),
}
_ID_CUED = re.compile(r"(?:\d{3}[ -]?\d{2}[ -]?\d{4}|\d{2} ?\d{3} ?\d{3} ?\d{3}|\d{13}(?:\d{2})?|[A-Z]{1,2}\d{6,8}|[A-Z0-9]{2}\d{6,7}[A-Z0-9]?)(?![\w])")
_ACCOUNT_CUED = re.compile(r"\d(?:[ -]?\d){5,17}(?!\w)")
# The check letters of a number of eight digits, by its remainder of 23.
_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def _compact(text: str) -> str:
    return re.sub(r"[ .-]", "", text)


def _mod97(text: str) -> bool:
    """An account number's check: its first four characters last, letters as two digits, remainder 1."""
    value = _compact(text)
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _luhn(text: str) -> bool:
    digits = [int(c) for c in _compact(text)][::-1]
    return sum(digits[::2]) % 10 == -sum(sum(divmod(2 * d, 10)) for d in digits[1::2]) % 10 and len(set(digits)) > 1


def _letter(text: str) -> bool:
    value = _compact(text)
    return _LETTERS[int(value[:8]) % 23] == value[8]


def _key(text: str) -> bool:
    """The last two of 15 digits are 97 less the remainder of the others; 2A and 2B stand for 19 and 18."""
    value = _compact(text).replace("2A", "19").replace("2B", "18")
    return len(value) == 15 and value.isdigit() and 97 - int(value[:13]) % 97 == int(value[13:])


_CHECKS = {"insurance": lambda _: True, "iban": _mod97, "letter": _letter, "key": _key, "payment": _luhn}


def _plausible(text: str) -> bool:
    """A cued number: a check letter must be right, and no part of a number in three parts is all zeros."""
    value = _compact(text)
    if re.fullmatch(r"\d{8}[A-Z]", value):
        return _letter(value)
    return not re.fullmatch(r"\d{9}", value) or not (value[:3] == "000" or value[3:5] == "00" or value[5:] == "0000")


_AFTER_CUE = re.compile(r"(?:[ ]?(?:no|nr|n|number|nummer|id)?[.°º]{0,2})?[\s:=#\"'.|-]{0,4}", re.I)

_HOUSE = r"\d{1,4}(?:[ ]?[a-z](?![\w]))?"
_DIRECTION = r"(?:(?:North|South|East|West|Old|New|Upper|Lower|Great|Little|[NSEW]\.?)[ ])?"
_PLACE = rf"(?:,?[ ](?:\d{{4,5}}[ ])?{_NAME}(?:[ ][A-Z]{{1,2}}\d[A-Z\d]?[ ]\d[A-Z]{{2}})?)"
_ADDRESS_AFTER = re.compile(rf"(?<![\w.,§/-])(\d{{1,5}}[a-z]?[ ]{_DIRECTION}(?:{_NAME}[ ]){{1,2}}(?:{'|'.join(STREET_AFTER)})\b\.?)(?![ ](?:signs?|names?)\b)(?:,[ ](?:Apt|Flat|Unit|Suite)\.?[ ]\d+\w?)?(?:,[ ]{_NAME}(?:[ ][A-Z]{{1,2}}\d[A-Z\d]?[ ]\d[A-Z]{{2}})?)?")
_ADDRESS_JOINED = re.compile(rf"(?<!\w)({_NAME}(?:straße|strasse|str\.|weg|gasse|allee|platz|ufer|damm|ring)[ ]{_HOUSE})(?:,[ ]\d{{5}}[ ]{_NAME})?")
_ADDRESS_BEFORE = re.compile(rf"(?<!\w)((?:{'|'.join(STREET_BEFORE)})[ ](?:(?:de|del|della|di|da|la|las|los)[ ]){{0,2}}{_NAME}(?:[ ]{_NAME})?,?[ ]{_HOUSE})(?:,[ ](?:\d{{5}}[ ])?{_NAME})?")
_ADDRESS_FRENCH = re.compile(rf"(?<![\w.,§/-])(\d{{1,4}}(?:[ ]?(?:bis|ter|[a-c]))?,?[ ](?:{'|'.join(STREET_FRENCH)})[ ](?:de[ ]la[ ]|de[ ]l['’]|du[ ]|des[ ]|de[ ]|d['’])?{_NAME}(?:[ ]{_NAME})?)(?:,[ ]\d{{5}}[ ]{_NAME})?")


@dataclass(frozen=True)
class NameBook:
    """Listed names and what they teach: stems and endings that recur in family names."""

    given: frozenset[str]
    family: frozenset[str]
    stems: Counter = field(default_factory=Counter)
    endings: Counter = field(default_factory=Counter)
    recurs: int = 3

    @staticmethod
    def of(names: Iterable[tuple[str | None, str | None]], recurs: int = 3) -> NameBook:
        rows = [(n.strip(), k) for n, k in names if n and n.strip()]
        family = frozenset(n for n, k in rows if k == "family")
        stems: Counter = Counter()
        endings: Counter = Counter()
        for name in family:
            for i in range(3, len(name) - 1):
                stems[name[:i]] += 1
                endings[name[i:]] += 1
        return NameBook(frozenset(n for n, k in rows if k == "given"), family, stems, endings, recurs)

    def anchors(self) -> set[str]:
        """Shortest recurring stems, and the listed family names that have none."""
        short = {s for s, n in self.stems.items() if n >= self.recurs and len(s) == 3}
        return short | {n for n in self.family if n[:3] not in short}

    def is_family(self, word: str) -> bool:
        def known(part: str) -> bool:
            part = part[:1] + part[1:].lower() if part.isupper() else part
            return part in self.family or any(self.stems[part[:i]] >= self.recurs and self.endings[part[i:]] >= self.recurs for i in range(3, len(part) - 1))

        return all(known(p) for p in word.split("-"))


class Words:
    """Where a text's words begin and end, by the single blanks between them."""

    def __init__(self, text: str) -> None:
        self.gaps, self.size = [m.start() for m in re.finditer("[ \xa0]", text)], len(text)

    def back(self, at: int, words: int) -> int:
        """The beginning of the word that is so many words before the one at ``at``."""
        i = bisect_left(self.gaps, at) - words - 1
        return self.gaps[i] + 1 if i >= 0 else 0

    def on(self, at: int, words: int) -> int:
        """The end of the word that is so many words after the one at ``at``."""
        i = bisect_left(self.gaps, at) + words
        return self.gaps[i] if i < len(self.gaps) else self.size


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Finder:
    """Finds the items of a text; built once per Python worker."""

    def __init__(self, book: NameBook) -> None:
        import ahocorasick

        self.book = book
        words: dict[str, set[str]] = {}
        for kind, literals in (
            ("mail", AT_SIGNS),
            *SCHEMES.items(),
            ("id", ID_CUES),
            ("account", ACCOUNT_CUES),
            ("digit", "0123456789"),
            ("after", [f" {w}" for w in STREET_AFTER]),
            ("joined", STREET_JOINED),
            ("before", [f"{w} " for w in STREET_BEFORE]),
            ("french", [f" {w} " for w in STREET_FRENCH]),
            ("name", book.anchors()),
            ("given", book.given),
        ):
            for literal in literals:
                words.setdefault(_lower(literal), set()).add(kind)
        self.automaton = ahocorasick.Automaton()
        for word, kinds in words.items():
            self.automaton.add_word(word, (len(word), tuple(sorted(kinds))))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[Item]:
        """Items ``(start, end, type)`` in order, none overlapping another; start counts from 0."""
        if not text:
            return []
        found: list[Item] = []
        at: dict[str, list[int]] = {kind: [] for kind in ("name", "given", "id", "account", "mailto", "tel", "digit", "after", "joined", "before", "french")}
        mails: list[tuple[int, int]] = []
        digit = -2
        for end, (length, kinds) in self.automaton.iter(_lower(text)):
            start = end - length + 1
            for kind in kinds:
                if kind == "digit":
                    if start != digit + 1:  # the first digit of a group
                        at["digit"].append(start)
                    digit = start
                elif kind == "mail":
                    mails.append((start, end + 1))
                elif kind in ("id", "account"):
                    at[kind].append(end + 1)
                elif kind in SCHEMES:
                    if not (start and text[start - 1].isalnum()):
                        at[kind].append(end + 1)
                else:
                    at[kind].append(start)
        before = 0
        for start, end in mails:
            self._mail(text, start, end, before, found)
            before = end
        for kind, pattern, item in (("mailto", _LINKED_MAIL, "email"), ("tel", _LINKED_PHONE, "phone")):
            for start in at[kind]:
                if match := pattern.match(text, start):
                    self._add(found, start, match.end(), item)
        self._ids(text, at["digit"], at["id"], at["account"], found)
        self._phones(text, at["digit"], found)
        streets = [(at[kind], pattern) for kind, pattern in (("after", _ADDRESS_AFTER), ("joined", _ADDRESS_JOINED), ("before", _ADDRESS_BEFORE), ("french", _ADDRESS_FRENCH)) if at[kind]]
        if streets or at["name"]:
            words = Words(text)
            for anchors, pattern in streets:
                self._addresses(text, anchors, pattern, words, found)
            for start in at["name"]:
                self._name(text, start, words, found)
        for start in at["given"]:
            self._given(text, start, found)
        return sorted(found)

    @staticmethod
    def _add(found: list[Item], start: int, end: int, kind: str) -> None:
        i = bisect_left(found, (start,))  # found stays in order
        if end > start and (i == len(found) or found[i][0] >= end) and (i == 0 or found[i - 1][1] <= start):
            found.insert(i, (start, end, kind))

    def _mail(self, text: str, start: int, end: int, low: int, found: list[Item]) -> None:
        """The mailbox to the left, as far as its characters go but not into the last anchor's; the domain to the right."""
        left = start
        while left > low and text[left - 1] == " ":
            left -= 1
        first = left
        while first > low and _LOCAL.match(text[first - 1]):
            first -= 1
        right = end
        while right < len(text) and text[right] == " ":
            right += 1
        spaced = left < start or right > end
        mailbox = text[first:left].lstrip(".'`=|/{?&!#$%*^~-")
        for mark in ("=", "|", "/", "'"):
            mailbox = mailbox.rpartition(mark)[2]
        domain = _DOMAIN.match(text, right)
        if not mailbox or mailbox.endswith(".") or not domain:
            return
        last = re.split(_DOT, domain.group(), flags=re.I)[-1]
        if not re.fullmatch(r"[A-Za-z]{2,}", last) or spaced and text[start:end] in "@＠﹫" and not re.search(r"[a-z]{2}", last, re.I):
            return
        at = left - len(mailbox)
        if text[at - 1 : at] in (":", "/") and _USER_OF_LINK.search(text, self._word_start(text, at, low), at):
            return
        self._add(found, at, domain.end(), "email")

    @staticmethod
    def _word_start(text: str, at: int, low: int) -> int:
        while at > low and not text[at - 1].isspace():
            at -= 1
        return at

    def _ids(self, text: str, digits: list[int], cues: list[int], accounts: list[int], found: list[Item]) -> None:
        for cue, cued in sorted([(c, False) for c in cues] + [(c, True) for c in accounts]):
            gap = _AFTER_CUE.match(text, cue, cue + 24)
            at = gap.end() if gap else cue
            for pattern in (*_FORMS.values(), _ID_CUED, *([_ACCOUNT_CUED] if cued else [])):
                value = pattern.match(text, at)
                if value and (pattern not in (_FORMS["iban"], _FORMS["payment"]) or cued or _CHECKS["iban" if pattern is _FORMS["iban"] else "payment"](value.group())) and _plausible(value.group()):
                    self._add(found, at, value.end(), "id_number")
                    break
        done = 0
        for at in digits:
            for start in (at - 3, at - 2, at):
                if start < done or start and (text[start - 1].isalnum() or text[start - 1] in "_.-"):
                    continue
                for kind, pattern in _FORMS.items():
                    value = pattern.match(text, start)
                    if value and value.end() > at and _CHECKS[kind](value.group()):
                        self._add(found, start, value.end(), "id_number")
                        done = value.end()
                        break

    def _phones(self, text: str, digits: list[int], found: list[Item]) -> None:
        """Runs of digits that may hold telephone numbers, from the first digit of a group and the sign before it."""
        done = 0
        for at in digits:
            if at < done:
                continue
            signed = at and text[at - 1] in "+(" and at > done
            if run := (signed and _NUMBER.match(text, at - 1)) or _NUMBER.match(text, at):
                self._phone(text, run, found)
                done = run.end()

    def _phone(self, text: str, run: re.Match, found: list[Item]) -> None:
        """All numbers of a run of digits: tried wherever a group of digits or a bracket begins, and again after each one found."""
        at, stop, joined, low = run.start(), run.end(), True, run.start()
        while at < stop:
            end = self._phone_at(text, at, stop)
            if end and (joined or self._stands_alone(text, low, at, end)):
                self._add(found, at, end, "phone")
                joined, low = True, end
            else:
                joined, end = False, None
            begin = _GROUP.search(text, end or at + 1, stop)
            at = begin.start() if begin else stop

    @staticmethod
    def _stands_alone(text: str, low: int, at: int, end: int) -> bool:
        """The digits before are no part of the number: a bracket, slash or dash parts them, or they are one short number or a date."""
        if text[at] == "(" or _APART.search(text, max(low, at - 6), at):
            return True
        if not _STRAY.fullmatch(text, max(low, at - 16), at):
            return False
        return text[at] == "0" or not re.search(r"[ \xa0]", text[at:end])

    @staticmethod
    def _phone_at(text: str, at: int, stop: int) -> int | None:
        """The end of the number that begins here and leaves nothing of the run that could belong to it."""
        for pattern in _PHONES:
            match = pattern.match(text, at)
            if match and (match.end() >= stop - 6 or _NEXT.match(text, match.end(), stop) or any(p.match(text, match.end() + 1) for p in _PHONES)):
                tail = _EXTENSION.match(text, match.end())
                if text[match.end() : match.end() + 1].isalnum() and not tail:
                    continue
                return tail.end() if tail else match.end()
        return None

    def _addresses(self, text: str, anchors: list[int], pattern: re.Pattern, words: Words, found: list[Item]) -> None:
        """Addresses around street words: no form has more than six words before its street word or ten after it."""
        low, high = words.back(anchors[0], 6), words.on(anchors[0], 10)
        spans = []
        for at in anchors[1:]:
            if words.back(at, 6) > high:
                spans.append((low, high))
                low = words.back(at, 6)
            high = max(high, words.on(at, 10))
        for low, high in [*spans, (low, high)]:
            for match in pattern.finditer(text, low, high):
                self._add(found, match.start(), match.end(), "address")

    def _name(self, text: str, at: int, words: Words, found: list[Item]) -> None:
        if at and (text[at - 1].isalnum() or text[at - 1] in "_@."):
            return
        match = _TOKEN.match(text, at)
        if not match or text[match.end() : match.end() + 1] in ("_", "@") or text[match.end() : match.end() + 1].isdigit():
            return
        word = match.group()
        if not self.book.is_family(word):
            return
        behind = at and text[at - 1] in " \xa0"
        low = words.back(at, 6)  # a given name, two initials and two particles at most
        left = _LEFT.search(text, low, at) if behind else None
        if left:
            given = left.group(1)
            first = given.split(" ")[0].split("\xa0")[0]
            if _INITIALS.match(given):
                self._add(found, left.start(1), match.end(), "name")
                return
            if first in TITLES and len(given) > len(first) + 1:  # a title and initials
                self._add(found, left.start(1) + len(first) + 1, match.end(), "name")
                return
            if first not in TITLES and not self.book.is_family(first):
                self._add(found, left.start(1), match.end(), "name")
                return
        right = _RIGHT.match(text, match.end())
        if right:
            first = right.group(1).split(" ")[0]
            lists = text[right.end() : right.end() + 1] == " " and self.book.is_family((_TOKEN.match(text, right.end() + 1) or match).group()) and _TOKEN.match(text, right.end() + 1)
            plain = all(p in self.book.given or p[:1] + p[1:].lower() in self.book.given for p in first.split("-"))
            if not lists and (plain or _INITIALS.match(right.group(1)) or first not in TITLES and not self.book.is_family(first)):
                start = at
                if particle := behind and _PARTICLES_LEFT.search(text, low, at):
                    start = particle.start()
                self._add(found, start, right.end(), "name")

    def _given(self, text: str, at: int, found: list[Item]) -> None:
        """A listed given name with a family name of any form, if a title or label stands before or a mailbox or telephone comes next."""
        if at and (text[at - 1].isalnum() or text[at - 1] in "_@.-'’"):
            return
        match = _GIVEN_FIRST.match(text, at)
        if not match or match.group(1) not in self.book.given or match.group(2) in _NO_FAMILY:
            return
        end = match.end()
        if text[end : end + 1].isalnum() or text[end : end + 1] in ("_", "@"):
            return
        i = bisect_left(found, (end,))
        reached = i < len(found) and found[i][2] in ("email", "phone") and found[i][0] - end <= 3 and not text[end : found[i][0]].strip(" \xa0,(<:;")
        if reached or _TITLE_LEFT.search(text, max(0, at - 16), at):
            self._add(found, at, end, "name")


#: What stands in place of an item.
PLACEHOLDERS = {"name": "[NAME]", "email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]"}


def replace(text: str | None, items: list[Item]) -> str | None:
    """``text`` with every item replaced by its placeholder, all else as it was."""
    if not text or not items:
        return text
    out, at = [], 0
    for start, end, kind in items:
        out += [text[at:start], PLACEHOLDERS[kind]]
        at = end
    return "".join([*out, text[at:]])


def _book(names: DataFrame, most: int) -> NameBook:
    rows = names.select("name", "kind").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the list of names has more than {most} rows")
    return NameBook.of((r[0], r[1]) for r in rows)


_finders: dict[str, Finder] = {}


def _finder(name: str, book: NameBook) -> Finder:
    """The finder of a list of names, built once per Python worker."""
    if name not in _finders:
        _finders.clear()
        _finders[name] = Finder(book)
    return _finders[name]


def find_pii(docs: DataFrame, doc_id: str, text: str, names: DataFrame, most_names: int = 200_000) -> DataFrame:
    """One row ``(doc_id, pii_type, start_pos, end_pos)`` per item; positions count characters from 1, the end is exclusive.

    Null and empty texts hold nothing. Repeated rows are searched each for itself. The list of names is
    a parameter of bounded size (``most_names`` rows, else an error); null and empty names are skipped and
    an empty list finds no names. Other columns are never read.
    """
    name, book = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(_book(names, most_names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _finder(name, book.value)
        for batch in batches:
            rows = [(i, kind, s + 1, e + 1) for i, t in zip(batch["doc_id"], batch["text"], strict=True) if t for s, e, kind in finder.find(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "pii_type", "start_pos", "end_pos"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, "doc_id bigint, pii_type string, start_pos bigint, end_pos bigint")


def redact(docs: DataFrame, doc_id: str, text: str, names: DataFrame, most_names: int = 200_000) -> DataFrame:
    """One row ``(doc_id, text, n_items)`` per document with typed placeholders; null and empty texts stay as they are."""
    name, book = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(_book(names, most_names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _finder(name, book.value)
        for batch in batches:
            items = [finder.find(t) if t else [] for t in batch["text"]]
            done = [replace(t, i) for t, i in zip(batch["text"], items, strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": pd.Series(done, dtype=object), "n_items": [len(i) for i in items]})

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, "doc_id bigint, text string, n_items bigint")
