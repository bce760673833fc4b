"""Every query against DuckDB over the given tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.fixtures import TABLES
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    result = duck.execute(entry_points.oracle_sql()[name])
    expected_columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(expected_columns)
    order = sorted(df.columns)
    at = [expected_columns.index(c) for c in order]
    got = Counter(repr(tuple(r[c] for c in order)) for r in df.collect())
    expected = Counter(repr(tuple(r[i] for i in at)) for r in result.fetchall())
    assert got == expected
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_is_the_audit_report(spark):
    df = entry_points.entry(spark)
    assert df.columns[:4] == ["job_id", "job_name", "job_url", "cluster_id"]
    assert df.count() > 0
