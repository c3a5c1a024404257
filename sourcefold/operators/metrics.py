"""Cost, yield and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Dollars for a million input tokens, by how a model's name begins.
PRICES = {"terra": 2.5, "terra-2": 3.0, "terra-2-mini": 0.5, "luna": 1.25}
QUERY_PRICE = 14.0
HALF, ANSWERED = 0.5, 30


def price(model: Column) -> Column:
    """The price of the longest name that a model's begins with; null for an unknown model."""
    by_length = sorted(PRICES.items(), key=lambda x: -len(x[0]))
    return F.coalesce(*[F.when(model.startswith(name), F.lit(x)) for name, x in by_length])


def run_cost(rows: DataFrame, key: list[str]) -> DataFrame:
    """Searches, tokens and dollars; a row with tokens of an unknown model makes the dollars null, blank counts add nothing."""
    cost = F.coalesce("input_tokens", F.lit(0)) / 1e6 * price(F.col("model"))
    unknown = F.coalesce(F.col("input_tokens") > 0, F.lit(False)) & price(F.col("model")).isNull()
    out = rows.groupBy(*key).agg(F.count_distinct("site_id").alias("sites"), F.sum("web_searches").alias("searches"), F.sum("input_tokens").alias("input_tokens"), F.sum(cost).alias("_c"), F.bool_or(unknown).alias("_u"))
    return out.select(*key, "sites", "searches", "input_tokens", F.when(~F.col("_u"), F.round(F.coalesce("_c", F.lit(0.0)) + F.col("searches") * QUERY_PRICE / 1000, 6)).alias("dollars"))


def one_row_per_site(rows: DataFrame) -> DataFrame:
    """The first pass of each site, searches summed over its passes."""
    return rows.groupBy("site_id").agg(F.min_by("pass_label", "seq").alias("pass_label"), F.min("seq").alias("seq"), F.sum("web_searches").alias("searches"))


def yield_summary(rows: DataFrame, reference: str) -> DataFrame:
    """Rates for each (group, class), beside the reference class of the same group, and the verdict."""
    each = rows.groupBy("grp", "cls").agg(F.count("*").alias("sites"), F.sum("found").alias("found"), F.sum("searches").alias("searches"))
    each = each.withColumn("rate", F.try_divide(F.col("found").cast("double"), F.col("searches").cast("double")))
    named = each.where(F.col("cls") == reference).select("grp", F.col("rate").alias("named_rate"))
    out = each.join(named, "grp", "left")
    verdict = F.when(F.col("cls") == reference, "reference").when(F.col("sites") < ANSWERED, "too few").when(F.col("rate") < HALF * F.col("named_rate"), "skip").otherwise("search")
    return out.select("grp", "cls", "sites", "found", "searches", F.round("rate", 6).alias("rate"), F.round(F.try_divide(F.col("rate"), F.col("named_rate")), 6).alias("ratio"), verdict.alias("verdict"))


def forecast(counts: DataFrame, per_class: DataFrame) -> DataFrame:
    """Expected searches and dollars for each (batch, class): the class's average, else the overall one."""
    overall = per_class.agg(F.try_divide(F.sum("searches"), F.sum("sites")).alias("_all"))
    own = per_class.select("cls", F.try_divide("searches", "sites").alias("_own"))
    out = counts.join(own, "cls", "left").join(F.broadcast(overall))
    expected = F.col("sites") * F.coalesce("_own", "_all")
    return out.select("batch", "cls", "sites", F.round(expected, 6).alias("searches"), F.round(expected * QUERY_PRICE / 1000, 6).alias("dollars"))
