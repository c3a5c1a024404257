"""Every query of the curation operators against its SQL, on the smallest tables."""

import math
import os
from collections import Counter

import pytest

from sourcefold.plans.catalog import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
DIR = os.environ.get("SOURCEFOLD_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def other():
    if not os.path.isdir(DIR):
        pytest.skip("no tables")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, other, name):
    found = QUERIES[name](spark, DIR)
    columns = sorted(found.columns)
    wanted = other.sql(ORACLES[name])
    assert sorted(wanted.columns) == columns
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in found.collect())
    sql = Counter(tuple(plain(v) for v in r) for r in wanted.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert rows == sql


def test_queries_without_sql_give_rows(spark, other):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, DIR).count() > 0
