"""Folding yearly rows and attaching provenance and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import blank_to_null, is_empty


def fold_years(rows: DataFrame, key: str, *, identity: list[str], varying: dict[str, str], year: str = "year", order: str = "ord") -> DataFrame:
    """One row for each key: its newest year is the reference.

    identity: the newest value that isn't empty. varying (column -> kind): the newest value that isn't empty, and
    where that is from before the reference year, a stamp `column@year` in backfilled_fields. One aggregation; of two
    rows of one year the first in order counts.
    """
    newest = lambda c, kind: F.max_by(F.struct(F.col(c).alias("v"), F.col(year).alias("y")), F.when(~is_empty(F.col(c), kind), F.struct(F.col(year), -F.col(order))))
    picked = [F.when(F.count_if(~is_empty(F.col(c), kind)) > 0, newest(c, kind)).alias(f"_{c}") for c, kind in [*((c, "string") for c in identity), *varying.items()]]
    out = rows.groupBy(key).agg(F.max(year).alias("reference_year"), F.min(year).alias("first_year"), F.count("*").alias("n_rows"), *picked)
    stamps = [F.when(F.col(f"_{c}.y") < F.col("reference_year"), F.concat(F.lit(f"{c}@"), F.col(f"_{c}.y").cast("string"))) for c in varying]
    return out.select(key, "reference_year", "first_year", "n_rows", *[F.col(f"_{c}.v").alias(c) for c in [*identity, *varying]], F.concat_ws("; ", *stamps).alias("backfilled_fields"))


def attribute_sources(seed: DataFrame, static: DataFrame, dated: DataFrame, key: str, attributes: list[str], years: dict[str, Column]) -> DataFrame:
    """The dataset behind each attribute of each key, as `attribute@dataset` in attribute order.

    static (key, attribute, dataset) wins over dated (key, year, attribute, dataset), which is read for the year that
    the value came from (years: column -> year).
    """
    long = seed.select(key, F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(a).alias("attribute"), years[a].alias("year")) for k, a in enumerate(attributes)])).alias("x")).select(key, "x.*")
    found = long.join(static.select(key, "attribute", F.col("dataset").alias("_s")), [key, "attribute"], "left").join(dated.select(key, "attribute", "year", F.col("dataset").alias("_d")), [key, "attribute", "year"], "left")
    found = found.withColumn("dataset", F.coalesce("_s", "_d")).where("dataset IS NOT NULL")
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat("attribute", F.lit("@"), "dataset").alias("t")))), lambda x: x["t"]), "; ")
    return seed.select(key).join(found.groupBy(key).agg(told.alias("attribute_sources")), key, "left").select(key, F.coalesce("attribute_sources", F.lit("")).alias("attribute_sources"))


def first_by(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def with_cached_places(sites: DataFrame, cache: DataFrame, fields: list[str]) -> DataFrame:
    """Places by site id, else by rounded point; blanks never replace what a site has. Adds `lookup`: hit or miss."""
    by_site = cache.where("site_id IS NOT NULL").select("site_id", F.struct(*fields).alias("_by_site"))
    by_point = cache.where("coord_key IS NOT NULL").select("coord_key", F.struct(*fields).alias("_by_point"))
    out = sites.join(by_site, "site_id", "left").join(by_point, "coord_key", "left").withColumn("_p", F.coalesce("_by_site", "_by_point"))
    filled = {f: F.coalesce(blank_to_null(F.col(f"_p.{f}")), F.col(f)) for f in fields}
    return out.withColumn("lookup", F.when(F.col("_p").isNull(), "miss").otherwise("hit")).withColumns(filled).drop("_by_site", "_by_point", "_p")


def misses(sites: DataFrame, cache: DataFrame) -> DataFrame:
    """The points that need a lookup, each once: of sites found neither by id nor by point."""
    left = sites.join(cache.where("site_id IS NOT NULL").select("site_id"), "site_id", "left_anti").join(cache.where("coord_key IS NOT NULL").select("coord_key"), "coord_key", "left_anti")
    return left.where("coord_key IS NOT NULL").groupBy("coord_key").agg(F.min("site_id").alias("site_id"))


def held_for_year(attribute_value: Column, reference_year: Column, backfill_year: Column, year: Column) -> tuple[Column, Column]:
    """Our value for one year: ours, empty for the newest year if ours was carried there, else ours with a note."""
    ours = F.coalesce(backfill_year, reference_year)
    kind = F.when(attribute_value.isNull() | ours.isNull(), "as held").when(year == ours, "same year").when(year == reference_year, "nothing held").otherwise("other year")
    return F.when(kind != "nothing held", attribute_value), kind
