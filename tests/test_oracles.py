"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from workload.oracles import all_oracles
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


@pytest.fixture(scope="module")
def oracles():
    return entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_its_sql(spark, oracles, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    duck = duckdb.connect()
    for table in TABLES.split():
        duck.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    result = duck.execute(oracles[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == normal(columns, result.fetchall())
    assert len(got) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(all_oracles()) == set(QUERIES)
