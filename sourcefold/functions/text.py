"""Blank, boolean, list and provenance texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words that mean a boolean.
TRUE_WORDS = ["yes", "y", "true", "t", "1"]
FALSE_WORDS = ["no", "n", "false", "f", "0"]
# Retired attribute names and their replacements.
ALIASES = {"found_site_name": "found_facility_name", "area": "area_square_meters", "waste_depth_meters": "waste_depth"}
DEPTH_BOUNDARY = 5.0


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def is_empty(value: Column, kind: str = "string") -> Column:
    """Null, blank, NaN, or an array of nothing but empties; false and 0 are values."""
    if kind == "double":
        return value.isNull() | F.isnan(value)
    if kind == "array":
        return value.isNull() | F.forall(value, lambda x: x.isNull() | (F.trim(x) == ""))
    return value.isNull() | (F.trim(value) == "")


def comparable_text(value: Column) -> Column:
    """Lower case, trimmed, without thousands commas."""
    return F.lower(F.regexp_replace(F.trim(F.coalesce(value, F.lit(""))), ",", ""))


def tristate(value: Column) -> Column:
    word = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def unknown_word(value: Column) -> Column:
    """Whether a text is none of the words that tristate() knows."""
    return ~F.lower(F.trim(F.coalesce(value, F.lit("")))).isin([*TRUE_WORDS, *FALSE_WORDS, "unknown", ""])


def list_items(value: Column) -> Column:
    """Items of a JSON list, or of a text that semicolons or commas part; trimmed, without blanks, each once."""
    text = F.coalesce(F.trim(value), F.lit(""))
    items = F.coalesce(F.when(text.startswith("["), F.from_json(text, "array<string>")), F.split(text, "[;,]"))
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != ""))


def canonical_attribute(name: Column) -> Column:
    text = F.trim(F.coalesce(name, F.lit("")))
    table = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), text)


def depth_band(low: Column, high: Column) -> tuple[Column, Column]:
    """The band of a depth in metres given as a range, and why there is none."""
    reason = F.when(low.isNull() | high.isNull(), "empty").when((low <= 0) | (high <= 0), "not a measurement").when((low <= DEPTH_BOUNDARY) != (high <= DEPTH_BOUNDARY), "straddles")
    return F.when(reason.isNull(), F.when(low <= DEPTH_BOUNDARY, "<=5m").otherwise(">5m")), reason


def provenance(text: Column, canonical: bool = True) -> Column:
    """`field@label; field@label` as a map; the last @ parts the two, later items win, items without either are left out."""
    items = F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.trim(x))
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.regexp_extract(x, r"^(.*)@([^@]*)$", 1)).alias("key"), F.trim(F.regexp_extract(x, r"^(.*)@([^@]*)$", 2)).alias("value")))
    if canonical:
        pairs = F.transform(pairs, lambda p: F.struct(canonical_attribute(p["key"]).alias("key"), p["value"].alias("value")))
    pairs = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    # of equal keys the last one stays
    kept = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(kept)


def sorted_map(entries: Column) -> Column:
    """A map as text, in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


def stable_order(*parts: Column) -> Column:
    """A pseudo-random order key that depends on the parts alone: 16 hexadecimal digits of a hash."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def significant(value: Column, digits: int = 6) -> Column:
    """A number rounded to so many significant digits."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - (digits - 1))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value / scale) * scale)


def without_controls(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", " ")


def id_text(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), r"\.0$", "")
