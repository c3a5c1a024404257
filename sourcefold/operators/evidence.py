"""Responses as evidence: one row for each value that a source gives, with why it can't be used, and what was left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import links as urls, text, tiers, values
from ..sources.tables import kept
from .nested import evidence_id

#: Links up to which they are broadcast; beyond that the join shuffles.
BROADCAST_LINKS = 200_000
# Attributes that say which facility a source is about, not what is found of it.
IDENTITY = ["found_facility_name", "found_location", "found_latitude", "found_longitude"]
NO_LINK, DEAD, UNUSABLE = "no link", "dead link", "unusable"


def _cited(read: DataFrame) -> DataFrame:
    return read.withColumns({"attribute": F.when(F.col("attribute_name").isNotNull(), text.canonical_attribute(F.col("attribute_name"))), "_mirror": urls.of_site(F.col("url"), urls.MIRRORS)})


def _linked(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows with `link_status` and the link that answers in place of the one that was written; links: (url, status, resolved_url), one row a link."""
    found = links.select(F.col("url").alias("_url"), urls.verdict(F.col("status")).alias("link_status"), F.col("status").alias("_status"), F.coalesce("resolved_url", "url").alias("_to"))
    found = kept(found)
    found = F.broadcast(found) if found.count() <= BROADCAST_LINKS else found
    written = F.trim(F.coalesce("url", F.lit("")))
    out = rows.withColumn("url", written).join(found, written == F.col("_url"), "left")
    return out.withColumns({"url": F.coalesce("_to", "url"), "link_status": F.coalesce("link_status", F.lit(""))}).drop("_url", "_to")


def extracted(read: DataFrame, links: DataFrame, supported: list[str], keep_broken: bool = False) -> DataFrame:
    """One row for each value of read (site_id, source_index, value_index, url, source_type, publication_date, attribute_name, value, unit, value_date).

    Sites that mirror others are left out, as are values that only say which facility it is and attributes that aren't
    supported. excluded is the first that holds of: no link, a dead one (unless keep_broken), a value that is empty or
    can't be converted; `exclusion` says it in words, and is empty for values that can be used. Null links count as none.
    """
    rows = _cited(read).where("_mirror IS NULL AND attribute IS NOT NULL").where(F.col("attribute").isin(supported) & ~F.col("attribute").isin(IDENTITY))
    rows = _linked(rows, links).withColumn("_n", values.normal(F.col("attribute"), F.col("value"), F.col("unit")))
    reason = F.col("_n.reason")
    code = F.when(F.col("url") == "", NO_LINK).when((F.col("link_status") == "Broken") & ~F.lit(keep_broken), DEAD).when(reason.isNotNull(), UNUSABLE)
    words = F.when(code == NO_LINK, "No clickable link.").when(code == DEAD, F.concat(F.lit("Link broken ("), "_status", F.lit(")."))).when(reason == "empty", "Value empty after normalization.").when(code == UNUSABLE, F.concat(F.lit("Value can't be used: "), reason, F.lit("."))).otherwise("")
    return rows.select(
        evidence_id("site_id", "source_index", "value_index").alias("evidence_id"), F.when(F.col("url") != "", urls.source_id(F.col("url"))).otherwise(F.concat(F.lit("src-"), F.col("site_id").cast("string"), F.format_string("-S%03d-%03d", F.col("source_index") + 1, F.col("value_index") + 1))).alias("source_id"),
        "site_id", "source_index", "url", "link_status", "attribute", "value", "unit", F.col("_n.usable").alias("normalized"), "value_date",
        tiers.source_tier(F.col("source_type"), F.col("publication_date"), F.col("attribute")).alias("tier"), code.alias("excluded"), words.alias("exclusion"),
    )


def listed_sources(read: DataFrame, links: DataFrame, supported: list[str]) -> DataFrame:
    """(site_id, source_index, url, facility_name, n_values): every source that isn't a mirror, those without a value among them."""
    rows = _cited(read).where("_mirror IS NULL")
    counted = F.count_if(F.coalesce(F.col("attribute").isin(supported) & ~F.col("attribute").isin(IDENTITY), F.lit(False)))
    each = rows.groupBy("site_id", "source_index").agg(F.min("url").alias("url"), F.min("facility_name").alias("facility_name"), counted.alias("n_values"))
    return _linked(each, links).select("site_id", "source_index", "url", "facility_name", "n_values")


def warnings(read: DataFrame, supported: list[str]) -> DataFrame:
    """(site_id, warning), each once: attributes that aren't supported, citations of mirrors with their number, attributes that only mirrors give."""
    rows = _cited(read).withColumn("_of", F.col("_mirror").isNotNull())
    by_site = rows.groupBy("site_id", "attribute").agg(F.max(~F.col("_of")).alias("kept"))
    known = F.col("attribute").isin(supported)
    unsupported = by_site.where(F.col("kept") & F.col("attribute").isNotNull() & ~known & ~F.col("attribute").isin(IDENTITY)).select("site_id", F.concat(F.lit("Unsupported attribute_name '"), "attribute", F.lit("' dropped.")).alias("warning"))
    only = by_site.where(~F.col("kept") & known).select("site_id", F.concat("attribute", F.lit(": every source was a dropped map site; not used.")).alias("warning"))
    dropped = rows.where("_of").groupBy("site_id", "_mirror").agg(F.count("*").alias("n")).select("site_id", F.concat(F.lit("Dropped "), F.col("n").cast("string"), F.lit(" citation(s) of "), "_mirror", F.lit(": map sites that copy others are not used as sources.")).alias("warning"))
    return unsupported.unionByName(only).unionByName(dropped)
