"""Years and partial dates in texts."""

from pyspark.sql import Column, functions as F

#: What a year and a partial date look like.
YEAR = r"\b(1[89]\d{2}|20\d{2})\b"
DATE = r"\b(1[89]\d{2}|20\d{2})(?:-(\d{1,2}))?(?:-(\d{1,2}))?"
EARLIEST = 1950


def parse_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text.cast("string"), F.lit("")), YEAR, 1), F.lit("")).cast("int")


def date_key(text: Column) -> Column:
    """(year, month, day); missing parts are 0, so that they sort first."""
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), DATE, k), F.lit("")).cast("int"), F.lit(0))
    return F.struct(part(1).alias("y"), part(2).alias("m"), part(3).alias("d"))


def value_year(text: Column, run_year: int) -> Column:
    """The year that a date begins with, from 1950 to the run's year; else the run's year."""
    year = F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"^\s*(\d{4})", 1), F.lit("")).cast("int")
    return F.when(year.between(EARLIEST, run_year), year).otherwise(run_year)


def year_exact(text: Column, year: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"^\s*(\d{4})", 1), F.lit("")) == year.cast("string"), F.lit(False))
