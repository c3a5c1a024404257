"""Nested responses: sources with values, read, converted, merged, checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

VALUE = "struct<attribute_name: string, value: string, unit: string, value_date: string>"
SOURCE = f"struct<url: string, source_type: string, publication_date: string, facility_name: string, values: array<{VALUE}>>"
RESPONSE = f"struct<sources: array<{SOURCE}>, notes: string>"
CITATION = "struct<url: string, source_type: string, publication_date: string>"
BY_ATTRIBUTE = f"struct<attributes: array<struct<attribute_name: string, value: string, unit: string, sources: array<{CITATION}>>>>"


def responses(flat: DataFrame) -> DataFrame:
    """(site_id, pass, body): JSON text of each response, from rows (site_id, pass, source, url, source_type, publication_date, facility_name, place, attribute_name, value, unit, value_date)."""
    values = F.transform(F.sort_array(F.collect_list(F.struct("place", "attribute_name", "value", "unit", "value_date"))), lambda v: F.struct(v["attribute_name"].alias("attribute_name"), v["value"].alias("value"), v["unit"].alias("unit"), v["value_date"].alias("value_date")))
    by_source = flat.groupBy("site_id", "pass", "source").agg(F.first("url").alias("url"), F.first("source_type").alias("source_type"), F.first("publication_date").alias("publication_date"), F.first("facility_name").alias("facility_name"), values.alias("values"))
    sources = F.transform(F.sort_array(F.collect_list(F.struct("source", "url", "source_type", "publication_date", "facility_name", "values"))), lambda s: F.struct(*[s[c].alias(c) for c in ("url", "source_type", "publication_date", "facility_name", "values")]))
    return by_source.groupBy("site_id", "pass").agg(F.to_json(F.struct(sources.alias("sources"))).alias("body"))


def read_sources(rows: DataFrame) -> DataFrame:
    """(site_id, pass, source_index, value_index, source fields, value fields); a source without values is one row."""
    read = rows.select("site_id", "pass", F.from_json("body", RESPONSE).alias("r"))
    sources = read.select("site_id", "pass", F.posexplode_outer("r.sources").alias("source_index", "s"))
    values = sources.select("site_id", "pass", "source_index", "s", F.posexplode_outer("s.values").alias("value_index", "v"))
    return values.select("site_id", "pass", "source_index", "value_index", "s.url", "s.source_type", "s.publication_date", "s.facility_name", "v.attribute_name", "v.value", "v.unit", "v.value_date")


def merged_passes(read: DataFrame) -> DataFrame:
    """Sources of all passes of a site numbered anew, in pass order; rows without a source are left out."""
    place = F.dense_rank().over(Window.partitionBy("site_id").orderBy("pass", "source_index")) - 1
    return read.where("site_id IS NOT NULL AND pass IS NOT NULL AND source_index IS NOT NULL").withColumn("merged_index", place.cast("long"))


def evidence_id(site: str, source: str, value: str):
    return F.concat(F.lit("ev-"), F.col(site).cast("string"), F.format_string("-S%03d-%03d", F.col(source) + 1, F.col(value) + 1))


def by_page(rows: DataFrame) -> DataFrame:
    """Attribute-first responses as one source per exact link: first fields that aren't blank, values counted."""
    read = rows.select("site_id", F.from_json("body", BY_ATTRIBUTE).alias("r"))
    values = read.select("site_id", F.posexplode("r.attributes").alias("a", "x"))
    cited = values.select("site_id", "a", "x.attribute_name", "x.value", F.posexplode("x.sources").alias("c", "s"))
    order = F.struct("a", "c")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    first = lambda c: F.min_by(c, F.when(~blank(F.col(c)), order))
    flat = cited.select("site_id", "a", "c", "attribute_name", "s.*")
    return flat.groupBy("site_id", "url").agg(F.when(F.count_if(~blank(F.col("source_type"))) > 0, first("source_type")).alias("source_type"), F.when(F.count_if(~blank(F.col("publication_date"))) > 0, first("publication_date")).alias("publication_date"), F.count("*").alias("cited"), F.count_distinct("attribute_name").alias("attributes"))


def problems(read: DataFrame, supported: list[str]) -> DataFrame:
    """(site_id, problem): what is wrong with the values of each site, each once."""
    found = F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim("url"), F.lit("")) == "", F.lit("source without link")),
            F.when(F.col("attribute_name").isNotNull() & ~F.col("attribute_name").isin(supported), F.concat(F.lit("unsupported attribute "), F.col("attribute_name"))),
            F.when(F.col("attribute_name").isNotNull() & (F.coalesce(F.trim("value"), F.lit("")) == ""), F.concat(F.lit("no value for "), F.col("attribute_name"))),
        )
    )
    return read.select("site_id", F.explode(found).alias("problem")).distinct()
