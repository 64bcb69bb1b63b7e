"""Morphological readings: positional tags, slots, and the algebra of cells with several readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slots in order with their vocabularies; the vocabularies are disjoint.
SLOTS = {
    "person": ["0", "1", "2", "3"],
    "case": ["nom", "gen", "dat", "acc", "abl", "voc", "loc"],
    "number": ["s", "p"],
    "gender": ["m", "f", "n", "c"],
    "tense": ["pres", "impf", "fut", "perf", "plup", "futp"],
    "voice": ["active", "passive"],
    "mood": ["ind", "sub", "inf", "imp", "part"],
    "category": ["pron", "prep", "conj", "adv", "interj"],
    "clitic": ["enclitic"],
}
# What each character of a nine-place tag means, by place.
TAG_PLACES = [
    ("category", {"p": "pron", "d": "adv", "r": "prep", "c": "conj", "i": "interj"}),
    ("person", {"1": "1", "2": "2", "3": "3"}),
    ("number", {"s": "s", "p": "p"}),
    ("tense", {"p": "pres", "i": "impf", "r": "perf", "l": "plup", "t": "futp", "f": "fut"}),
    ("mood", {"i": "ind", "s": "sub", "n": "inf", "m": "imp", "p": "part"}),
    ("voice", {"a": "active", "p": "passive"}),
    ("gender", {"m": "m", "f": "f", "n": "n", "c": "c"}),
    ("case", {"n": "nom", "g": "gen", "d": "dat", "a": "acc", "b": "abl", "v": "voc", "l": "loc"}),
]


def tag_slots(tag: Column) -> dict[str, Column]:
    """Slot columns of a positional tag; unknown characters and missing places are null, an infinitive has person 0."""
    out = {}
    for place, (slot, table) in enumerate(TAG_PLACES, 1):
        char, value = F.substring(tag, place, 1), F.lit(None).cast("string")
        for key, name in table.items():
            value = F.when(char == key, name).otherwise(value)
        out[slot] = value
    out["person"] = F.when((out["mood"] == "inf") & out["person"].isNull() & out["case"].isNull(), "0").otherwise(out["person"])
    out["clitic"] = F.lit(None).cast("string")
    return {slot: out[slot] for slot in SLOTS}


def render(slots: dict[str, Column]) -> Column:
    """Slots in their order with single spaces; nulls are left out. A value outside its vocabulary raises an error."""
    checked = [F.when(c.isNull() | c.isin(SLOTS[s]), c).otherwise(F.raise_error(F.concat(F.lit(f"not a {s}: "), c))) for s, c in slots.items()]
    return F.concat_ws(" ", *checked)


def tag_reading(tag: Column) -> Column:
    """The rendered reading of a positional tag; empty if it says nothing."""
    return render(tag_slots(tag))


def slot_of(reading: Column, slot: str) -> Column:
    """One slot of a rendered reading, or null."""
    return F.get(F.filter(F.split(reading, " "), lambda t: t.isin(SLOTS[slot])), F.lit(0))


def merge_readings(readings: Column) -> Column:
    """``array<string>`` of readings as one cell: sorted, joined by |, without readings that another one covers and exceeds."""
    distinct = F.array_distinct(F.filter(readings, lambda r: r.isNotNull() & (r != "")))

    def covered(r: Column) -> Column:
        return F.exists(distinct, lambda o: (o != r) & (F.size(F.array_except(F.split(r, " "), F.split(o, " "))) == 0))

    several = F.array_join(F.array_sort(F.filter(distinct, lambda r: ~covered(r))), "|")
    return F.when(F.size(distinct) > 1, several).otherwise(F.array_join(distinct, "|"))


def compatible(ours: Column, gold: Column) -> Column:
    """No slot that both state disagrees; common gender fits any, the clitic counts for nothing, a category stands alone."""
    ok = F.lit(True)
    for slot in SLOTS:
        if slot == "clitic":
            continue
        a, b = slot_of(ours, slot), slot_of(gold, slot)
        clash = a.isNotNull() & b.isNotNull() & (a != b)
        if slot == "gender":
            clash = clash & (a != "c") & (b != "c")
        if slot == "category":
            clash = clash | (a.isNull() != b.isNull())
        ok = ok & ~clash
    return ok


def cell_state(cell: Column, gold: Column) -> Column:
    """absent (no cell), blank, exact, compatible or contradicted."""
    parts = F.split(cell, "\\|")
    return (
        F.when(cell.isNull(), "absent")
        .when(cell == "", "blank")
        .when(F.array_contains(parts, gold), "exact")
        .when(F.exists(parts, lambda r: compatible(r, gold)), "compatible")
        .otherwise("contradicted")
    )


def reading_class(reading: Column) -> Column:
    return (
        F.when(slot_of(reading, "category").isin("prep", "conj", "adv", "interj"), "indeclinable")
        .when(slot_of(reading, "mood").isNotNull(), "verb form")
        .when(slot_of(reading, "case").isNotNull(), "nominal form")
        .otherwise("other")
    )
