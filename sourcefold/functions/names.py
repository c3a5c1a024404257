"""Names of places, facilities and operators."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Words that many facility names share, company forms, abbreviations, words that part one site from another.
GENERIC = (
    "landfill landfills sanitary municipal regional county city site dump dumpsite dumping facility facilities waste solid disposal recycling transfer station center centre lfgte gas energy "
    "project inc llc co corp company management services domestic garbage trash rubbish ground urban land mrf the of and at de do da del la el los las aterro sanitario lixao controlado "
    "vertedero relleno botadero deponie discarica openstreetmap tip refuse depot grounds nuisance lieu enfouissement technique let d l resource recovery integrated iwmf installation stockage "
    "dechets non dangereux hazardous open air tiradero cielo abierto municipio diposit controlat controlled ditches trenches for in a des du closed former disused abandoned inactive decommissioned historic historical"
).split()
COMPANY = "ltd limited plc llp lp gmbh mbh ag kg ohg ev sa sas sau sarl eurl srl spa scrl bv nv vof oy oyj ab as asa aps kft zrt nyrt bt doo dd sro pty ltda lda sl slu cv".split()
ABBREVIATIONS = {"lf": "landfill", "slf": "landfill", "ldfl": "landfill", "sani": "sanitary", "msw": "waste", "cnty": "county", "twp": "township"}
QUALIFIERS = "north south east west northeast northwest southeast southwest upper lower old new i ii iii iv 1 2 3 4".split()
SMALL = "de del la las los el y ahora now antes formerly h honorable s rl ac sc sapi sab".split()


def fold(text: str | None) -> str | None:
    """Case folded, compatibility forms written out, accents and format characters off, % as a word."""
    if text is None:
        return None
    if text.isascii():
        out = text.lower()
    else:
        out = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").casefold()
    return out.replace("%", " percent ")


@F.pandas_udf(T.StringType())
def folded(texts: pd.Series) -> pd.Series:
    """fold() of each text."""
    return texts.map(fold)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """How alike two texts are by their longest common blocks."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")


def plain(text: Column) -> Column:
    """Words of any script, folded, one space between them."""
    return F.trim(F.regexp_replace(folded(text), r"(?U)[\W_]+", " "))


def distinctive_words(name: Column) -> Column:
    """The sorted words of a name that tell a facility from others."""
    table = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    words = F.transform(F.filter(F.split(F.regexp_replace(folded(name), r"[^a-z0-9]+", " "), " "), lambda w: w != ""), lambda w: F.coalesce(F.try_element_at(table, w), w))
    is_code = lambda w: w.rlike("[a-z]") & w.rlike("[0-9]") & ~w.rlike("^[0-9]+(st|nd|rd|th)$")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: ~w.isin([*GENERIC, *COMPANY, "epr"]) & ~is_code(w))))


def qualifiers(words: Column) -> Column:
    return F.filter(words, lambda w: w.isin(QUALIFIERS) | w.rlike("^[0-9]+(st|nd|rd|th)?$"))


def containment(a: Column, b: Column) -> Column:
    """Share of the shorter word list found in the longer; 0 if both have qualifiers and share none; null without words."""
    qa, qb = qualifiers(a), qualifiers(b)
    conflict = (F.size(qa) > 0) & (F.size(qb) > 0) & ~F.arrays_overlap(qa, qb)
    bare_a, bare_b = F.array_except(a, qa), F.array_except(b, qb)
    both = (F.size(bare_a) > 0) & (F.size(bare_b) > 0)
    x, y = F.when(both, bare_a).otherwise(a), F.when(both, bare_b).otherwise(b)
    share = F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(None)).when(conflict, 0.0).otherwise(share)


def operator_words(name: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(F.regexp_replace(folded(name), r"\([^()]*\)", " "), r"[^a-z0-9]+", " "), " "), lambda w: w != "")
    return F.filter(words, lambda w: ~w.isin([*SMALL, *COMPANY]) & ~w.rlike("^(19|20)[0-9]{2}$"))


def same_operator(a: Column, b: Column) -> Column:
    """Whether the words of one name are all among the other's, or both run together to the same letters."""
    x, y = operator_words(a), operator_words(b)
    within = (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))
    return within | ((F.size(x) > 0) & (F.array_join(x, "") == F.array_join(y, "")))
