"""Found values: one row of each source and attribute, and closures beside verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_key
from ..functions.values import comparable

NOT_A_FACILITY = "Not a Waste Facility"


def collapse_found(rows: DataFrame, yearly: list[str]) -> DataFrame:
    """One row for each site, review and attribute, and year where the attribute is yearly, of
    rows (site_id, review_id, attribute, year, value, value_date, used, ord, status_reason).

    A value that could load comes first, then the newest, then the first given; status_reason names the other values that
    could load and aren't the same, each once, in that order. Repeats are folded first, so a group gathers one label for
    each different value and date of one source. Nulls in the key are a group; a null value is "", without a date "undated".
    """
    value = F.coalesce("value", F.lit(""))
    key = date_key(F.col("value_date"))
    of = [F.col("site_id"), F.col("review_id"), F.col("attribute"), F.when(F.col("attribute").isin(yearly), F.col("year")).alias("_y")]
    order = F.struct((~F.col("used")).alias("a"), (-key["y"]).alias("y"), (-key["m"]).alias("m"), (-key["d"]).alias("d"), F.col("ord").alias("o"), value.alias("v"))
    label = F.concat(value, F.lit(" ("), F.coalesce(F.nullif(F.trim("value_date"), F.lit("")), F.lit("undated")), F.lit(")"))
    names = ["year", "value", "value_date", "used", "ord", "status_reason"]
    once = rows.select(*of, order.alias("_o"), label.alias("_label"), comparable(value, F.col("attribute")).alias("_c"), F.struct(*names).alias("_row"))
    once = once.groupBy("site_id", "review_id", "attribute", "_y", "_label", "_c", F.col("_o.a").alias("_idle")).agg(F.min("_o").alias("_o"), F.min_by("_row", "_o").alias("_row"))
    labels = F.array_sort(F.collect_list(F.when(~F.col("_idle"), F.struct("_o", "_label", "_c"))))
    best = once.groupBy("site_id", "review_id", "attribute", "_y").agg(F.min_by("_row", "_o").alias("_row"), F.min_by("_c", "_o").alias("_first"), labels.alias("_labels"))
    other = F.transform(F.filter("_labels", lambda x: x["_c"] != F.col("_first")), lambda x: x["_label"])
    reason = F.coalesce("_row.status_reason", F.lit(""))
    said = F.when(F.size(other) > 0, F.concat(reason, F.lit(" The source also gives "), F.array_join(other, "; "), F.lit("."))).otherwise(reason)
    return best.select("site_id", "review_id", "attribute", *[F.col(f"_row.{n}").alias(n) for n in names[:-1]], said.alias("status_reason"))


def closures(rows: DataFrame) -> DataFrame:
    """(site_id, reported): what rows (site_id, attribute, value, planned, ord) say of a site having closed, each once, in order.

    Plans to close say nothing of it. A site gathers one text for each different year.
    """
    closed = F.when((F.col("attribute") == "facility_status") & (F.col("value") == "Inactive"), "facility_status = Inactive").when(
        (F.col("attribute") == "closing_year") & (F.trim("value") != "") & ~F.coalesce("planned", F.lit(False)), F.concat(F.lit("closing_year = "), "value"))
    once = rows.select("site_id", "ord", closed.alias("said")).where("said IS NOT NULL").groupBy("site_id", "said").agg(F.min("ord").alias("ord"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "said"))), lambda x: x["said"])
    return once.groupBy("site_id").agg(ordered.alias("reported"))


def flag_closures(rows: DataFrame, review: Column) -> DataFrame:
    """rows with a warning on verdicts for review that call a site no facility although the run found it closed.

    Only these verdicts are joined; the others pass as they are.
    """
    verdict = F.coalesce((F.col("attribute") == "facility_type") & (F.col("value") == NOT_A_FACILITY) & review, F.lit(False))
    warning = F.concat(F.lit(" CHECK: this run also found "), F.array_join("reported", "; "), F.lit(" - is this a closed landfill misread as never a waste site?"))
    flagged = rows.where(verdict).join(closures(rows), "site_id", "left").withColumn("status_reason", F.concat(F.coalesce("status_reason", F.lit("")), F.coalesce(warning, F.lit("")))).drop("reported")
    return rows.where(~verdict).unionByName(flagged)
