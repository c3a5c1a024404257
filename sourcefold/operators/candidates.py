"""New places that reviewers name, listed once and for all: later runs add to the list and never change what is in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.links import url_key
from ..functions.names import plain
from . import spatial

FOUND_BY = "reviewer"


def candidates(found: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list, citing): a row for each page and plain name called a new site, and one for each site whose search cited it.

    found: (ord, review_id, site_id, url, name, latitude, longitude, line: what a value says); decisions: (review_id,
    decision, reviewer, reviewed, notes). list: (candidate_id, url, name, latitude, longitude, found_by) from the first
    row; citing: (candidate_id, site_id, note). Sites are rows, since a page may be cited by any number.
    """
    new = decisions.where("decision = 'new'").dropDuplicates(["review_id"])
    rows = found.join(new, "review_id")
    key = F.concat(F.lit("new-"), F.substring(F.sha2(F.concat_ws("|", F.lit(FOUND_BY), F.coalesce(url_key(F.col("url")), F.lit("")), F.coalesce(plain(F.col("name")), F.lit(""))), 256), 1, 12))
    rows = rows.withColumn("candidate_id", key)
    first = rows.groupBy("candidate_id").agg(F.min_by(F.struct("url", "name", "latitude", "longitude"), "ord").alias("x")).select("candidate_id", "x.*", F.lit(FOUND_BY).alias("found_by"))
    by = F.concat_ws(" on ", F.nullif(F.trim("reviewer"), F.lit("")), F.col("reviewed").cast("string"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.trim("line") != "", F.struct("ord", "line")))), lambda x: x["line"]), "; ")
    one = rows.groupBy("candidate_id", "site_id", "review_id").agg(lines.alias("lines"), F.min(by).alias("by"), F.min(F.nullif(F.trim("notes"), F.lit(""))).alias("notes"))
    note = F.concat_ws(" ", F.concat(F.lit("Marked as a new site"), F.when(F.col("by") != "", F.concat(F.lit(" ("), "by", F.lit(")"))).otherwise(F.lit("")), F.lit(" under site "), F.col("site_id").cast("string"), F.lit(".")), F.when(F.col("lines") != "", F.concat(F.lit("It gives "), "lines", F.lit("."))), F.col("notes"))
    citing = one.groupBy("candidate_id", "site_id").agg(F.min_by(note, "review_id").alias("note"))
    return first, citing


def merged(listed: DataFrame, listed_citing: DataFrame, new: DataFrame, citing: DataFrame, sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list, citing) after a run. Rows that are listed stay as they are, edits and all; others are added with the site nearest to them.

    listed has the columns of candidates() and nearest_site_id, nearest_km; sites: (site_id, other_latitude,
    other_longitude, area). A second run over the same decisions adds nothing.
    """
    added = new.join(listed.select("candidate_id"), "candidate_id", "left_anti")
    points = added.where("latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180").select("candidate_id", "latitude", "longitude")
    near = spatial.nearest(points, sites, "candidate_id").select("candidate_id", F.col("site_id").alias("nearest_site_id"), F.round("km", 1).alias("nearest_km"))
    both = listed.unionByName(added.join(near, "candidate_id", "left"))
    more = citing.join(listed_citing.select("candidate_id", "site_id"), ["candidate_id", "site_id"], "left_anti")
    return both, listed_citing.unionByName(more)
