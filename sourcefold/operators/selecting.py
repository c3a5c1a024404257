"""Which sites are searched: by name, by batch, as a mixed sample, as a follow-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import searchable, text
from ..sources.tables import kept

#: Of a mixed sample: how many rows at most take turns by country, and how many have generic names.
TURNS, HARD_CASES = 50, 30


def classed(sites: DataFrame) -> DataFrame:
    """sites (site_name, original_name, sources) with class, reason and whether a search skips them."""
    found = searchable.name_class(F.col("site_name"), F.col("original_name"), F.col("sources"))
    return sites.withColumn("_n", found).withColumns({"class": F.col("_n.class"), "reason": F.col("_n.reason"), "skipped": F.col("_n.class").isin(searchable.SKIPPED)}).drop("_n")


def skip_candidates(sites: DataFrame, batches: DataFrame) -> DataFrame:
    """One row for each batch (country, batch) and site of it that isn't named: the rule and a link to a map.

    A country may lie in several batches; sites of countries in none are left out. Without a point the link is empty.
    """
    point = F.concat(F.lit("https://www.google.com/maps/search/?api=1&query="), F.col("latitude").cast("string"), F.lit(","), F.col("longitude").cast("string"))
    unnamed = classed(sites).where(F.col("class") != searchable.NAMED)
    return unnamed.join(batches, "country").select("batch", "class", "reason", "site_id", "site_name", "original_name", "country", "sources", "latitude", "longitude", F.coalesce(point, F.lit("")).alias("map"))


def follow_up(before: DataFrame, after: DataFrame, searched: DataFrame, has: Column) -> DataFrame:
    """Sites of `after` that have the gating attribute now, had it not in `before`, and were searched in this run.

    `has` is read in both tables; a site that is new in `after` had it not. searched may repeat a site.
    """
    had = before.where(F.coalesce(has, F.lit(False))).select("site_id")
    return after.where(F.coalesce(has, F.lit(False))).join(had, "site_id", "left_anti").join(searched.select("site_id"), "site_id", "left_semi")


def mixed_sample(sites: DataFrame, size: int, priority: list[str]) -> DataFrame:
    """(place, site_id, reason): a sample of `size` sites that is the same on every run.

    First all of the priority countries, in their order; then the other countries take turns, the largest first (equal
    ones by name), for half of what is left and TURNS at most; then HARD_CASES at most of generic names; then any others.
    Within a stage a hash of id, name, country and stage orders rows. Sites without an id are left out, of repeated ids the
    row with the smallest name and country counts; sites without a country take no turn. Only `size` rows pass a stage's
    limit, and a country's turns are limited before they are shuffled.
    """
    if size <= 0:
        return sites.select(F.lit(0).alias("place"), "site_id", F.lit("").alias("reason")).limit(0)
    blank = lambda name: F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))
    rows = sites.select("site_id", blank("site_id").alias("id"), blank("site_name").alias("name"), blank("country").alias("country")).where("id <> ''")
    rows = rows.groupBy("site_id", "id").agg(F.min(F.struct("name", "country")).alias("r")).select("site_id", "id", "r.name", "r.country")
    order = lambda salt: [text.stable_order(F.col("id"), F.col("name"), F.col("country"), F.lit(salt)), F.col("id")]

    def numbered(stage: DataFrame, before: int, by: list[Column]) -> DataFrame:
        # at most `size` rows: the stage's limit came first
        return kept(stage.withColumn("place", (F.row_number().over(Window.orderBy(*by)) + before).cast("int")).select("place", "site_id", "id", "reason"))

    def left_of(chosen: DataFrame | None) -> DataFrame:
        return rows if chosen is None else rows.join(chosen.select("id"), "id", "left_anti")

    chosen, n = None, 0

    def take(stage: DataFrame, limit: int, by: list[Column]) -> None:
        nonlocal chosen, n
        if limit > 0:
            rows_of = numbered(stage.orderBy(*by).limit(limit), n, by)
            chosen = rows_of if chosen is None else chosen.unionByName(rows_of)
            n += rows_of.count()

    rank = F.array_position(F.array(*[F.lit(x) for x in priority]).cast("array<string>"), F.col("country"))
    take(rows.where(F.col("country").isin(priority)).withColumn("reason", F.concat(F.lit("priority_country:"), "country")), size, [rank, *order("priority")])
    turns = min(TURNS, (size - n) // 2)
    if turns > 0:
        others = rows.where((F.col("country") != "") & ~F.col("country").isin(priority))
        sizes = others.groupBy("country").agg(F.count("*").alias("sites"))
        turn = others.withColumn("turn", F.row_number().over(Window.partitionBy("country").orderBy(*order("country_balance")))).where(F.col("turn") <= turns)
        take(turn.join(sizes, "country").withColumn("reason", F.concat(F.lit("country_balanced:"), "country")), turns, [F.col("turn"), F.desc("sites"), F.col("country")])
    take(left_of(chosen).where(searchable.generic_name(F.col("name"))).withColumn("reason", F.lit("generic_name_hard_case")), min(HARD_CASES, size - n), order("generic_hard_case"))
    take(left_of(chosen).withColumn("reason", F.lit("deterministic_fill")), size - n, order("deterministic_fill"))
    return chosen.select("place", "site_id", "reason")


def listed(rows: DataFrame, group: str, value: str, into: str) -> DataFrame:
    """One row a group (group, into): its values as texts, in order, comma-joined; null where it has none but nulls.

    rows must not repeat a value of a group. Values are sorted and joined in ranges, so that the task that writes a
    group's text gathers one piece for each range, not one row for each value; the text itself is one value of a row.
    """
    texts = rows.select(F.col(group), F.col(value).cast("string").alias("_v")).repartitionByRange(group, "_v").withColumn("_part", F.spark_partition_id())
    pieces = texts.groupBy(group, "_part").agg(F.array_join(F.array_sort(F.collect_list("_v")), ",").alias("_t"), F.count("_v").alias("_n"))
    # a piece without values is null, and not collected
    pieces = pieces.select(group, F.when(F.col("_n") > 0, F.struct("_part", "_t")).alias("_p"))
    found = pieces.groupBy(group).agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    return found.select(group, F.when(F.size("_p") > 0, F.array_join(F.col("_p._t"), ",")).alias(into))
