"""Links: exact-URL keys, hosts, respellings and fetch verdicts."""

from pyspark.sql import Column, functions as F

# Sites that only mirror other sources.
MIRRORS = ["mapcarta.com", "maptons.com"]
BROKEN = ["404", "410", "redirect loop"]


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Scheme (https if there is none), host and the rest of a link, the fragment left out."""
    text = F.trim(F.coalesce(url, F.lit("")))
    text = F.regexp_replace(text, "#.*$", "")
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.when(scheme == "", "https").otherwise(scheme), F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), F.regexp_replace(rest, r"^[^/?]*", "")


def url_key(url: Column) -> Column:
    """Lower-case scheme and host without www., no trailing slash, no fragment; path and query as they are."""
    scheme, host, rest = url_parts(url)
    return F.concat(scheme, F.lit("://"), F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(rest, "/+$", ""))


def source_id(url: Column) -> Column:
    return F.concat(F.lit("src-"), F.substring(F.sha2(url_key(url), 256), 1, 12))


def of_site(url: Column, sites: list[str]) -> Column:
    """The site of the list that a link's host is, or is under; null for none."""
    host = F.regexp_replace(F.regexp_replace(url_parts(url)[1], r":\d+$", ""), r"\.+$", "")
    return F.coalesce(*[F.when((host == s) | host.endswith("." + s), s) for s in sites])


def url_variants(url: Column) -> Column:
    """Other spellings to try: a literal comma, and the slash at the end toggled."""
    comma = F.regexp_replace(url, "%2[Cc]", ",")
    toggled = F.when(comma.endswith("/"), F.regexp_replace(comma, "/$", "")).otherwise(F.concat(comma, F.lit("/")))
    return F.filter(F.array_distinct(F.array(comma, toggled)), lambda x: x != url)


def verdict(status: Column) -> Column:
    return F.when(status == "200", "OK").when(status.isin(BROKEN), "Broken").otherwise("Unverified")


def retryable(status: Column) -> Column:
    return (verdict(status) == "Unverified") & (status.isin("429", "timeout") | status.startswith("5"))
