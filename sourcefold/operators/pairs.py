"""Sites and the sources cited for them: pairs, registries, shared pages, warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import names
from ..functions.geo import haversine_km
from ..sources.tables import kept

#: Rows that bear equal names are held in blocks of about so many.
BLOCK = 1_000


def plain(name: Column) -> Column:
    """Letters and digits of any script in lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"(?U)[\W_]+", " "))


def sources_registry(citations: DataFrame) -> DataFrame:
    """(source, title, tier, times_cited, sites): one row for each source, its first citation's fields."""
    first = F.min(F.struct("ord", "title", "tier")).alias("_f")
    return citations.groupBy("source").agg(first, F.count("*").alias("times_cited"), F.count_distinct("site_id").alias("sites")).select("source", F.col("_f.title").alias("title"), F.col("_f.tier").alias("tier"), "times_cited", "sites")


def review_id(site: Column, page: Column, name: Column) -> Column:
    return F.concat(F.lit("rev-"), site.cast("string"), F.lit("-"), F.substring(F.sha2(F.concat_ws("|", page, name), 256), 1, 12))


def site_source_pairs(citations: DataFrame) -> DataFrame:
    """One row for each (site, page, plain name): its best-rated citation, and the one that places it (placed, else rough, else first)."""
    place = F.min(F.struct((~F.col("placed")).alias("a"), (~F.col("rough")).alias("b"), "ord", "latitude", "longitude")).alias("_p")
    out = citations.groupBy("site_id", "page", "name").agg(F.min(F.struct("tier", "ord")).alias("_r"), place, F.count("*").alias("cited"))
    return out.select("site_id", "page", "name", review_id(F.col("site_id"), F.col("page"), F.col("name")).alias("review_id"), F.col("_r.tier").alias("tier"), F.col("_r.ord").alias("rated_by"), F.col("_p.ord").alias("placed_by"), F.col("_p.latitude").alias("latitude"), F.col("_p.longitude").alias("longitude"), "cited")


def shared_pages(pairs: DataFrame) -> DataFrame:
    """(site_id, page, name, shared_with): pairs whose page and name other sites cite too, with how many and the smallest such site.

    Counts and two smallest sites are aggregated; no group is collected, however many sites cite a page.
    """
    groups = pairs.select("page", "name", "site_id").distinct().groupBy("page", "name").agg(F.count("*").alias("_n"), F.min("site_id").alias("_a"), F.max("site_id").alias("_z")).where("_n > 1")
    return pairs.join(groups, ["page", "name"]).select("site_id", "page", "name", (F.col("_n") - 1).alias("others"), F.when(F.col("_a") == F.col("site_id"), F.col("_z")).otherwise(F.col("_a")).alias("other_site"))


def measured(pairs: DataFrame, sites: DataFrame, far_km: float = 5.0) -> DataFrame:
    """pairs with km to our point, `far` over 5 km, and flags as a list."""
    own = sites.select("site_id", F.col("latitude").alias("_la"), F.col("longitude").alias("_lo"))
    km = haversine_km(F.col("_la"), F.col("_lo"), F.col("latitude"), F.col("longitude"))
    out = pairs.join(own, "site_id", "left").withColumn("km", km)
    flags = F.array_compact(F.array(F.when(F.col("km") > far_km, "far"), F.when(F.col("name") == "", "no name"), F.when(F.col("latitude").isNull(), "no place")))
    return out.withColumn("flags", F.array_join(flags, ",")).drop("_la", "_lo")


def collapsed(rows: DataFrame, key: list[str], order: list[Column], comparable: Column) -> DataFrame:
    """The first row of each key by order, and how many other values the key has."""
    rows = rows.withColumns({"_o": F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]), "_c": comparable})
    return rows.groupBy(*key).agg(F.min_by(F.struct("value", "ord", "_c"), "_o").alias("w"), F.count_distinct("_c").alias("n")).select(*key, F.col("w.value").alias("value"), F.col("w.ord").alias("ord"), (F.col("n") - 1).alias("other_values"))


def datasets_found(citations: DataFrame, searches: int = 3, facilities: int = 2, named: int = 12) -> DataFrame:
    """Pages that many searches found, or that name several facilities."""
    name = F.when(F.col("name") != "", F.col("name"))
    counts = citations.groupBy("page").agg(F.count_distinct("site_id").alias("searches"), F.count_distinct(name).cast("int").alias("facilities")).where((F.col("searches") >= searches) | (F.col("facilities") >= facilities))
    # only the first names of a page are gathered
    first = citations.where("name <> ''").select("page", "name").distinct().withColumn("_k", F.row_number().over(Window.partitionBy("page").orderBy("name"))).where(F.col("_k") <= named)
    said = first.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("name")), "; ").alias("names"))
    return counts.join(said, "page", "left").select("page", "searches", "facilities", F.coalesce("names", F.lit("")).alias("names"))


def merged_points(points: DataFrame, key: str, km: float = 2.0) -> DataFrame:
    """Places of each key, points within km of an earlier one left out; earlier is by `ord`."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "latitude", "longitude"))), lambda x: F.struct(x["latitude"].alias("la"), x["longitude"].alias("lo")))
    none = F.array().cast("array<struct<la: double, lo: double>>")
    kept = F.aggregate(ordered, none, lambda acc, p: F.when(F.exists(acc, lambda q: haversine_km(q["la"], q["lo"], p["la"], p["lo"]) <= km), acc).otherwise(F.array_append(acc, p)))
    return points.groupBy(key).agg(F.size(kept).alias("places"))


def in_blocks(rows: DataFrame, on: list[str], key: str) -> DataFrame:
    """(*on, ids): the keys of rows that are equal in `on`, in blocks of about BLOCK, so that no class is one row."""
    rows = kept(rows.select(*on, key))
    sizes = rows.groupBy(*on).agg(F.ceil(F.count("*") / BLOCK).alias("_n"))
    equal = [F.col(f"r.{x}").eqNullSafe(F.col(f"s.{x}")) for x in on]
    number = F.pmod(F.xxhash64(F.col(f"r.{key}")), F.col("_n"))
    return rows.alias("r").join(sizes.alias("s"), equal).select("r.*", number.alias("_b")).groupBy(*on, "_b").agg(F.collect_list(key).alias("ids")).drop("_b")


def similar_names(rows: DataFrame, key: str, group: str, words: str) -> DataFrame:
    """(a, b, containment, similarity) of all rows a < b of a group whose word lists (letters and digits) share a word.

    Equal lists of a group are one class, and what an ordered pair of lists gives is worked out once, however many rows
    and groups bear them. The pairs of rows are written out from blocks of ids of two classes, after the last shuffle.
    """
    spark = rows.sparkSession
    named = kept(rows.where(F.size(words) > 0).select(F.col(key).alias("id"), F.col(group).alias("g"), F.array_join(words, " ").alias("x")).distinct())
    classes = kept(named.select("g", "x").distinct())
    word = classes.select("g", "x", F.explode(F.split("x", " ")).alias("w"))
    met = kept(word.join(word.withColumnRenamed("x", "y"), ["g", "w"]).select("g", "x", "y").distinct())
    wa, wb = F.split("x", " "), F.split("y", " ")
    inside = names.containment(wa, wb)
    # few bytes and much work: not coalesced
    scores = met.select("x", "y").distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "x", "y")
    scores = kept(scores.select("x", "y", inside.alias("containment"), F.when(inside == 0, 0.0).otherwise(F.greatest(inside, names.sequence_ratio("x", "y"))).alias("similarity")))
    blocks = kept(in_blocks(named, ["g", "x"], "id"))
    both = met.join(scores, ["x", "y"]).join(blocks, ["g", "x"]).join(blocks.select("g", F.col("x").alias("y"), F.col("ids").alias("others")), ["g", "y"])
    return both.select("others", "containment", "similarity", F.explode("ids").alias("a")).select("a", F.explode(F.filter("others", lambda b: b > F.col("a"))).alias("b"), "containment", "similarity")
