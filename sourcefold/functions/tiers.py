"""Credibility tiers of sources and of values that are already held."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import provenance

# Tiers by source type, spellings of source types that were used before, tiers by dataset.
TYPE_TIERS = {
    "regulator": 1,
    "court decision": 1,
    "permit or registry": 1,
    "municipal document": 1,
    "environmental impact assessment": 1,
    "operator disclosure": 1,
    "peer-reviewed article": 2,
    "government statistics": 2,
    "intergovernmental dataset": 2,
    "news report": 3,
    "trade press": 3,
    "ngo report": 3,
    "company directory listing": 4,
    "map or coordinate directory": 4,
    "wiki or aggregator": 4,
}
EARLIER_TYPES = {
    "regulator / court decision": "court decision",
    "eia": "environmental impact assessment",
    "operator website": "operator disclosure",
    "operator website / company profile": "company directory listing",
    "journal article": "peer-reviewed article",
    "academic journal": "peer-reviewed article",
    "newswire": "news report",
    "map / coordinate directory": "map or coordinate directory",
}
DATASET_TIERS = {
    "usa_ghgrp_2026": 1,
    "canada_ghgrp_2021": 1,
    "eprtr_2022": 1,
    "mexico_inegi_2016": 1,
    "lmop_2024": 1,
    "sinir_2024": 1,
    "waste_atlas_landfills_2013": 3,
    "waste_atlas_dumpsites_2013": 3,
    "manual_entry": 3,
    "gpw_2021": 4,
    "osm_2022": 4,
}
UNDATED_CAP, PROMOTABLE, OVERRIDES, TRUSTED, LOWEST = 3, 3, 2, 2, 5
STALE_ATTRIBUTES, STALE_YEARS, STALE_FLOOR = ["annual_incoming_waste_metric_tonnes", "waste_in_place_metric_tonnes"], 3, 3


def lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def source_type(value: Column) -> Column:
    """A source type of the vocabulary: as written, by an earlier spelling, by what it begins with, or by its head; else ''."""
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    head = F.trim(F.regexp_extract(text, r"^([^/|,]*)", 1))
    known = lambda x: F.when(x.isin(list(TYPE_TIERS)), x)
    begins = F.coalesce(*[F.when(text.startswith(old), new) for old, new in EARLIER_TYPES.items()])
    return F.coalesce(known(text), lookup(EARLIER_TYPES, text), begins, known(head), lookup(EARLIER_TYPES, head), F.lit(""))


def source_tier(kind: Column, publication_date: Column, attribute: Column | None = None) -> Column:
    """1 to 5 by source type; a source without a date is 3 at best; a map directory is 3 for a location."""
    own = source_type(kind)
    tier = F.coalesce(lookup(TYPE_TIERS, own), F.lit(LOWEST))
    if attribute is not None:
        tier = F.when((own == "map or coordinate directory") & (attribute == "found_location"), 3).otherwise(tier)
    undated = F.coalesce(F.trim(publication_date), F.lit("")) == ""
    return F.when((own != "") & undated, F.greatest(tier, F.lit(UNDATED_CAP))).otherwise(tier)


def dataset_tier(token: Column) -> Column:
    return F.coalesce(lookup(DATASET_TIERS, F.lower(F.trim(token))), F.lit(LOWEST))


def baseline_tier(datasets: Column) -> tuple[Column, Column]:
    """The best tier of datasets joined by +, and the tokens that have none."""
    tokens = F.filter(F.transform(F.split(F.coalesce(datasets, F.lit("")), r"\+"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    tiers = F.filter(F.transform(tokens, lambda x: lookup(DATASET_TIERS, x)), lambda x: x.isNotNull())
    return F.coalesce(F.array_min(tiers), F.lit(LOWEST)), F.array_join(F.array_sort(F.filter(tokens, lambda x: ~x.isin(list(DATASET_TIERS)))), ", ")


def stale_tier(tier: Column, attribute: Column, reference_year: Column, backfill_year: Column) -> Column:
    """A tier better than 3 loses one for a value carried over three years or more, for the amounts that change."""
    old = attribute.isin(STALE_ATTRIBUTES) & (tier < STALE_FLOOR) & (reference_year - backfill_year >= STALE_YEARS)
    return F.when(old, tier + 1).otherwise(tier)


def trusted(attribute: str, filled: Column, sources: Column) -> Column:
    """Whether a held value is known to come from tier 1 or 2: by what filled it before, else by its dataset."""
    by_fill = F.regexp_extract(F.try_element_at(provenance(filled), F.lit(attribute)), r"^Tier ([1-5])$", 1)
    tier = F.when(by_fill != "", by_fill.cast("int")).otherwise(dataset_tier(F.try_element_at(provenance(sources), F.lit(attribute))))
    return F.coalesce(tier, F.lit(LOWEST)) <= TRUSTED
