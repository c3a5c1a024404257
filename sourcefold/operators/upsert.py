"""Upserts, refreshes, comparisons of tables and re-keying."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def run_log(rows: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """Newest row of each key; counters add up over all its rows (null if none has one); the newest model that isn't blank stays."""
    model = F.max_by("model", F.when(F.trim("model") != "", F.col("seq")))
    return rows.groupBy(*key).agg(F.max("seq").alias("seq"), *[F.sum(c).alias(c) for c in counters], F.when(F.count_if(F.trim("model") != "") > 0, model).alias("model"))


def links(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """(url, status, text): a page read again keeps its verdict and takes the new text; one fetched again takes both."""
    p, f = previous.select("url", F.col("status").alias("ps"), F.col("text").alias("pt")), fresh.select("url", F.col("status").alias("fs"), F.col("text").alias("ft"), "text_only")
    status = F.when(F.col("text_only") & F.col("ps").isNotNull(), F.col("ps")).otherwise(F.coalesce("fs", "ps"))
    return p.join(f, "url", "full").select("url", status.alias("status"), F.coalesce("ft", "pt").alias("text"))


def keep_date_if_same(previous: DataFrame, fresh: DataFrame, key: list[str], fields: list[str], date: str) -> DataFrame:
    """The newer answer of each key; an answer that says the same keeps its date."""
    old = previous.select(*key, F.struct(*fields).alias("_o"), F.col(date).alias("_od"))
    new = fresh.select(*key, F.struct(*fields).alias("_n"), F.col(date).alias("_nd"))
    both = old.join(new, key, "full")
    when = F.when(F.col("_n").isNull(), F.col("_od")).when(F.col("_o").eqNullSafe(F.col("_n")), F.col("_od")).otherwise(F.col("_nd"))
    return both.select(*key, *[F.when(F.col("_n").isNotNull(), F.col(f"_n.{f}")).otherwise(F.col(f"_o.{f}")).alias(f) for f in fields], when.alias(date))


def usable_response(attempts: DataFrame, key: list[str]) -> DataFrame:
    """The response to keep of each key: a failed attempt never replaces a usable one; else the newest."""
    return attempts.groupBy(*key).agg(F.min(F.struct("failed", (-F.col("seq")).alias("s"))).alias("w")).select(*key, (-F.col("w.s")).alias("seq"), F.col("w.failed").alias("failed"))


def refreshed(sites: DataFrame, winners: DataFrame, attributes: list[str]) -> DataFrame:
    """sites with the winners' values where there is one, and a stamp `attribute@tier` for each."""
    wide = winners.groupBy("site_id").pivot("attribute", attributes).agg(F.first("value").alias("v"), F.first("tier").alias("t"))
    out = sites.join(wide, "site_id", "left")
    stamps = [F.when(F.col(f"{a}_t").isNotNull(), F.concat(F.lit(f"{a}@Tier "), F.col(f"{a}_t").cast("string"))) for a in attributes]
    return out.select(*[c for c in sites.columns if c not in attributes], *[F.coalesce(F.col(f"{a}_v"), F.col(a)).alias(a) if a in sites.columns else F.col(f"{a}_v").alias(a) for a in attributes], F.concat_ws("; ", *stamps).alias("stamps"))


def different(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with multiplicity, and on which side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def unknown_words(rows: DataFrame, column: str, vocabulary: list[str]) -> DataFrame:
    """Values of a column outside its vocabulary, with counts."""
    return rows.where(~F.col(column).isin(vocabulary)).groupBy(column).agg(F.count("*").alias("n"))


def map_ids(shared: DataFrame) -> DataFrame:
    """(old_id, status, new_id) through records that an old and a new id share, from (old_id, data_source, record, new_id).

    mapped: every record leads to one new id; partly: some records lead nowhere; split: to several; unmapped: none
    leads anywhere; merged: mapped, as another old id is, to the same new id.
    """
    each = shared.distinct().groupBy("old_id").agg(F.count("*").alias("n"), F.count("new_id").alias("linked"), F.min("new_id").alias("lo"), F.max("new_id").alias("hi"))
    status = F.when(F.col("linked") == 0, "unmapped").when(F.col("lo") != F.col("hi"), "split").when(F.col("linked") < F.col("n"), "partly").otherwise("mapped")
    out = each.withColumns({"status": status, "new_id": F.when(F.col("lo") == F.col("hi"), F.col("lo"))})
    same = F.count("*").over(Window.partitionBy("new_id"))
    return out.withColumn("_m", F.when(F.col("new_id").isNotNull(), same)).select("old_id", F.when(F.col("_m") > 1, "merged").otherwise(F.col("status")).alias("status"), "new_id")


def rekeyed(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """rows with new ids in a column, for ids that are mapped."""
    ids = mapping.where("status = 'mapped'").select(F.col("old_id").alias("_o"), F.col("new_id").alias("_n"))
    return rows.join(ids, F.col(column) == F.col("_o")).withColumn(column, F.col("_n")).drop("_o", "_n")
