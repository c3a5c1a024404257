"""Where queries and their SQL are registered, and the views that they run on.

A view is SQL over the given tables that means the same to Spark and to an ANSI engine; `{name}` stands for a table
or another view.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query; {view} in its SQL stands for a view, spelled out as common table expressions."""

    def register(run: Callable) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return run

    return register


def needed(sql: str) -> list[str]:
    """The views that sql needs, those that others build on first."""
    found: list[str] = []
    for name in re.findall(r"\{(\w+)\}", sql):
        if name in VIEWS:
            found += [x for x in [*needed(VIEWS[name]), name] if x not in found]
    return found


def with_views(sql: str) -> str:
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    views = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in needed(sql))
    body = plain(sql).strip()
    if not views:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view over given tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = {x: table(spark, sf_dir, x) for x in set(re.findall(r"\{(\w+)\}", VIEWS[name]))}
    return spark.sql(VIEWS[name], **parts)
