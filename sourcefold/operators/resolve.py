"""Conflict resolution: one value for each key, and what became of the value that was held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tiers import OVERRIDES, PROMOTABLE


def pick_values(rows: DataFrame, key: list[str], *, tier: str, date: str, value: str, source: str, order: list[str], carry: list[str] = ()) -> DataFrame:
    """The row of each key to load: best tier, newest date, the value that most sources give, first in order.

    Two aggregations and no sort: first the best row of each value and its number of sources, then the best value.
    Returns the key, value, tier, date, the order columns, carry, and n_sources.
    """
    newest = -F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), F.lit(-(2**62)))
    rest = F.struct(date, *order, *carry)
    each = rows.groupBy(*key, value).agg(F.min(F.struct(F.col(tier).alias("_tier"), newest.alias("_newest"), *[F.col(c) for c in order], rest.alias("_rest"))).alias("_best"), F.count_distinct(source).alias("n_sources"))
    best = each.groupBy(*key).agg(F.min(F.struct("_best._tier", "_best._newest", (-F.col("n_sources")).alias("_n"), *[F.col(f"_best.{c}") for c in order], F.struct(F.col(value).alias("_value"), F.col("_best._rest").alias("_rest")).alias("_all"))).alias("_w"))
    return best.select(*key, F.col("_w._all._value").alias(value), F.col("_w._tier").alias(tier), *[F.col(f"_w._all._rest.{c}").alias(c) for c in [date, *order, *carry]], (-F.col("_w._n")).alias("n_sources"))


def source_counts(rows: DataFrame, key: list[str], value: str, source: str) -> DataFrame:
    """Distinct sources for each value of a key, and for its other values."""
    each = rows.groupBy(*key, value).agg(F.count_distinct(source).alias("agree"))
    every = each.groupBy(*key).agg(F.sum("agree").alias("_all"))
    return each.join(every, key).select(*key, value, "agree", (F.col("_all") - F.col("agree")).alias("dissent"))


def outcome(held: Column, found: Column, same: Column, held_tier: Column, found_tier: Column, newer_status: Column) -> Column:
    """What a found value means beside the one held."""
    return (
        F.when(found.isNull(), "Not found")
        .when(held.isNull(), "Filled empty baseline")
        .when(same, "Confirmed baseline")
        .when((found_tier < held_tier) & (found_tier <= OVERRIDES), "Overrides baseline")
        .when(found_tier <= held_tier, "Conflict - needs review")
        .when(newer_status & (found_tier <= PROMOTABLE), "Overrides baseline")
        .otherwise("Conflict - lower credibility")
    )


def arbitrate(evidence: DataFrame, held: DataFrame, key: list[str], *, recent: bool, newer: int = 3) -> DataFrame:
    """Found against held values, for each key.

    evidence: key, value, tier, date, year, source, ord; held: key, held, held_tier, held_year. A held value can be
    challenged by tiers 1 to 3 only, an empty field is filled from any. recent: a value of a lower tier, within those
    that may challenge, that is `newer` years newer than the winner replaces it if it differs.
    """
    judged = evidence.join(held, key, "left").where(F.col("held").isNull() | (F.col("tier") <= PROMOTABLE))
    winner = pick_values(judged, key, tier="tier", date="date", value="value", source="source", order=["ord"], carry=["year", "held"])
    counts = source_counts(judged, key, "value", "source")
    if recent:
        first = winner.select(*key, F.col("tier").alias("_tier"), F.col("year").alias("_year"), F.col("value").alias("_value"))
        late = judged.join(first, key).where((F.col("tier") > F.col("_tier")) & (F.col("tier") <= PROMOTABLE) & (F.col("year") >= F.col("_year") + newer))
        late = late.join(counts.select(*key, "value", "agree"), [*key, "value"])
        order = F.struct((-F.unix_micros(F.col("date").cast("timestamp"))).alias("d"), F.col("tier").alias("t"), (-F.col("agree")).alias("n"), F.col("ord").alias("o"), F.struct("value", "tier", "year", "_value").alias("v"))
        late = late.groupBy(*key).agg(F.min(order).alias("_w")).where("_w.v.value <> _w.v._value").select(*key, F.col("_w.v.value").alias("_lv"), F.col("_w.v.tier").alias("_lt"), F.col("_w.v.year").alias("_ly"))
        winner = winner.join(late, key, "left").select(*key, F.coalesce("_lv", "value").alias("value"), F.coalesce("_lt", "tier").alias("tier"), F.coalesce("_ly", "year").alias("year"))
    winner = winner.select(*key, "value", "tier", "year").join(counts, [*key, "value"], "left")
    # a key whose evidence may not challenge the held value
    weak = evidence.groupBy(*key).agg(F.min("tier").alias("best"))
    out = weak.join(held, key, "full").join(winner, key, "left")
    newer_status = F.lit(recent) & (F.col("year") >= F.col("held_year") + newer)
    told = outcome(F.col("held"), F.coalesce("value", F.when(F.col("best").isNotNull(), F.lit(""))), F.col("value").eqNullSafe(F.col("held")), F.col("held_tier"), F.coalesce("tier", "best"), F.coalesce(newer_status, F.lit(False)))
    return out.select(*key, "held", "value", "tier", F.coalesce("agree", F.lit(0)).alias("agree"), F.coalesce("dissent", F.lit(0)).alias("dissent"), (F.col("held_tier") - F.col("tier")).alias("margin"), told.alias("outcome"))


def best_source(rows: DataFrame, key: list[str], tier: str, order: str, url: str) -> DataFrame:
    """The most credible source with a link for each key."""
    named = rows.where(F.coalesce(F.trim(url), F.lit("")) != "")
    return named.groupBy(*key).agg(F.min(F.struct(F.col(tier).alias("t"), F.col(order).alias("o"), F.col(url).alias("u"))).alias("w")).select(*key, F.col("w.t").alias(tier), F.col("w.o").alias(order), F.col("w.u").alias(url))
