"""Evidence held against the pages it cites: whether quote and stated place are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .page_places import stated_places_on_pages
from .pages import menu_only, quote_results

LITTLE, IN_PART, HTML = "little text", "read in part", "html"
NOT_FOUND = ["not found", "partly"]


def checked_evidence(evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """evidence (source_id, quote, address, coordinates, basis, lat, lon) with quote_on_page and place_on_page.

    pages: (source_id, text, kind, note), one row a page. A page noted as of little text has none. What isn't found, or
    partly, on a page that was read in part may stand in the rest: `not in the part read`; on an HTML page of which only
    the menu was kept it counts as `no page text`. Null where nothing is quoted or stated. Pages are folded once for all
    rows that cite them; rows and pages meet by source_id alone.
    """
    held = pages.where((F.coalesce("text", F.lit("")) != "") & (F.coalesce("note", F.lit("")) != LITTLE))
    notes = held.select("source_id", (F.coalesce("note", F.lit("")) == IN_PART).alias("_part"), ((F.col("kind") == HTML) & menu_only(F.col("text"))).alias("_menu"))
    texts = held.select("source_id", "text")
    out = quote_results(evidence, texts, "source_id").withColumnRenamed("result", "quote_on_page")
    out = stated_places_on_pages(out, texts, "source_id").join(notes, "source_id", "left")
    for column in ("quote_on_page", "place_on_page"):
        open_ = F.col(column).isin(NOT_FOUND)
        out = out.withColumn(column, F.when(open_ & F.col("_part"), "not in the part read").when(open_ & F.col("_menu"), "no page text").otherwise(F.col(column)))
    return out.select(*evidence.columns, "quote_on_page", "place_on_page")
