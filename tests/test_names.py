from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glossaria.functions import names as P




@pytest.mark.parametrize(("head", "want"), [("Roma", True), ("L", False), ("roma", False), ("-Roma", True), ("", False)])
def test_is_name(one, head, want):
    assert one(P.is_name(F.col("h")), h=head) is want


@pytest.mark.parametrize(
    ("xml", "want"),
    [
        ('<sense><hi rend="ital">nom. sing.</hi> <hi rend="ital">a town in</hi> Picenum, now <bibl>Plin.</bibl></sense>', "a town in Picenum"),
        ('<sense><hi rend="ital">Roma, a city; the chief</hi></sense>', "a city"),
        ('<sense><hi rend="ital">v. alia</hi></sense>', ""),
        ("<sense>nothing</sense>", ""),
        ('<sense><cit><hi rend="ital">quoted</hi></cit> <hi rend="ital">a hill of the</hi></sense>', "a hill"),
    ],
)
def test_name_definition(one, xml, want):
    assert one(P.name_definition(F.col("x"), F.col("h")), x=xml, h="Rōma") == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("a daughter of Aeolus, who slept", "daughter of Aeolus"), ("Roma, a city of Latium", "city of Latium"), ("adj., a king (rare) about 460 B.C.", "king about 460"), ("the town", "town"), ("", "")],
)
def test_name_clean(one, text, want):
    assert one(P.name_clean(F.col("x"), F.col("h")), x=text, h="Roma") == want


def test_sense_lines_stop_at_the_budget(one):
    xml = 'ago, ēgi <etym>old</etym> (x)<sense level="1" n="I"><hi rend="ital">to drive</hi></sense><sense level="2" n="A"><hi rend="ital">conj.</hi> to lead</sense><sense level="1" n="II"><hi rend="ital">to do</hi>; <hi rend="ital">to make</hi></sense>'
    assert one(P.sense_lines(F.col("x")), x=xml).split("\n")[:3] == ["ago, ēgi", "I. to drive", "II. to do; to make"]
    assert one(P.sense_lines(F.col("x"), 25), x=xml).split("\n") == ["ago, ēgi", "I. to drive"]


@pytest.mark.parametrize(("text", "want"), [("abditus, v. abdo", True), ("abditus, a, um, Part. of abdo.", True), ("amo, v. a. to love", False), ("x, v. abdo, fin. b.", True), ("x " * 90 + ", v. abdo", False), ("rosa, a flower", False)])
def test_is_pointer(one, text, want):
    assert one(P.is_pointer(F.col("x")), x=text) is want


@pytest.mark.parametrize(
    ("gloss", "body", "want"),
    [("Athenian sculptor", "a sculptor, Plin.", "sculptor"), ("Athenian sculptor", "a sculptor of Athens, Athenae", "Athenian sculptor"), ("Roman surname", "a surname", "Roman surname"), ("island in the Aegean Sea", "an island", "island in the Aegean Sea"), ("hail! (Persian)", "hail", "hail!"), ("Greek", "x", "Greek"), ("Greek general", "στρατηγός", "Greek general")],
)
def test_unstated_people(one, gloss, body, want):
    once = one(P.strip_unstated_people(F.col("x"), F.col("h")), x=gloss, h=body)
    assert once == want == one(P.strip_unstated_people(F.col("x"), F.col("h")), x=once, h=body)


def test_reuses_target(one):
    args = [F.col(c) for c in "abc"]
    assert one(P.reuses_target(*args), a="sane, adv., v. sanus", b="healthy, sound", c="sound, healthy, whole") is True
    assert one(P.reuses_target(*args), a="sane, adv., v. sanus", b="indeed, truly", c="sound") is False
