"""In which order a bill's versions came, from their notes, dates and numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INTRODUCED, AMENDMENT, CHAMBER_PASSAGE, FINAL_PASSAGE, ENACTED, UNKNOWN = 0, 1, 2, 3, 4, 99
_ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]


def extract_ordinal(note: Column) -> Column:
    """The number of a version among those of its stage: ``(S-2)``, an ordinal word, ``#3``, ``c2``, a number at the end, else 0."""
    low = F.lower(note)
    number = lambda text, p: F.regexp_extract(text, p, 1)
    paren = number(low, r"\([sh]-(\d+)\)")
    part = number(low, r"\)\s*-\s*(\d+)\s*$")
    out = F.when(paren != "", paren.cast("double") + F.when(part != "", part.cast("double") / 100).otherwise(0.0))
    for i, word in enumerate(_ORDINALS, 1):
        out = out.when(low.contains(word), float(i))
    for text, p in ((note, r"#\s*(\d+)\b"), (low, r"\b[a-z](\d+)\b"), (note, r"(\d+)\s*$")):
        out = out.when(number(text, p) != "", number(text, p).cast("double"))
    return out.otherwise(0.0)


#: fixed values: (pattern, pattern that must not be found, stage, ordinal or None for the note's own, added to it); the first that fits counts
STAGES = [
    (r"public act|public law|\bchapter|passed legislature|concurred", None, ENACTED, None, 0.0),
    (r"veto", None, FINAL_PASSAGE, 3.0, 0.0),
    (r"reenroll", None, FINAL_PASSAGE, 2.0, 0.0),
    (r"governor", None, FINAL_PASSAGE, 1.0, 0.0),
    (r"enroll|\ber\b", None, FINAL_PASSAGE, 0.0, 0.0),
    (r"^(senate|house)\s*-", None, CHAMBER_PASSAGE, 0.5, 0.0),
    (r"\be\d+\b", r"substitute|committee", CHAMBER_PASSAGE, None, 0.0),
    (r"engross", r"substitute|committee", CHAMBER_PASSAGE, None, 0.0),
    (r"conference|\breport|\breferr|placed on calendar|as passed", None, CHAMBER_PASSAGE, None, 0.25),
    (r"(?s)^(?=.*engross).*(substitute|amend|comparison|\bc\d+\b)", None, AMENDMENT, None, 0.5),
    (r"substitute|amend|comparison|\bc\d+\b", None, AMENDMENT, None, 0.0),
    (r"introduced|\bfiled\b|\bpb\b|original|^bill$", None, INTRODUCED, None, 0.0),
    (r"^bill text$", None, INTRODUCED, 0.0, 0.0),
]


def note_stage(note: Column) -> Column:
    """struct(stage, ordinal) of a version note."""
    low, own = F.lower(note), extract_ordinal(note)
    chain = None
    for pattern, without, stage, ordinal, added in STAGES:
        fits = low.rlike(pattern) if without is None else low.rlike(pattern) & ~low.rlike(without)
        value = F.struct(F.lit(stage).alias("stage"), (F.lit(ordinal) if ordinal is not None else own + F.lit(added)).alias("ordinal"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain.otherwise(F.struct(F.lit(UNKNOWN).alias("stage"), F.lit(0.0).alias("ordinal")))


def sort_key(note: Column, date: Column) -> Column:
    """struct(stage, date or empty, ordinal); only well-formed fuzzy dates count."""
    s = note_stage(note)
    dated = F.when(date.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?\z"), date).otherwise("")
    return F.struct(s["stage"].alias("stage"), dated.alias("date"), s["ordinal"].alias("ordinal"))
