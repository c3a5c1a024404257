"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of links (a, b): comp is the smallest node that can be reached.

    Every round each node points at its smallest neighbour, pointers are doubled until they end at roots, and the
    links are contracted to roots; links inside a root vanish. Both loops end after logarithmically many rounds, and
    every round is written to a table.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        to = stored(both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("node"), F.least("a", "p").alias("comp")))
        while True:
            up = to.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
            further = stored(to.join(up, to.comp == up._n, "left").select("node", F.coalesce("_c", "comp").alias("comp"), (F.coalesce("_c", "comp") != F.col("comp")).alias("moved")))
            to = further.select("node", "comp")
            if further.where("moved").isEmpty():
                break
        up = to.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        if found is None:
            found = to
        else:
            found = stored(found.join(up, found.comp == up._n, "left").select("node", F.coalesce("_c", "comp").alias("comp")))
        ends = links.join(up, links.a == up._n).select(F.col("_c").alias("a"), "b")
        ends = ends.join(up, ends.b == up._n).select("a", F.col("_c").alias("b")).where("a <> b")
        links = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("comp")) if found is None else found
