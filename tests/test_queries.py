"""Every registered query runs; those with a SQL twin match DuckDB, with
no cross join and at most two scalar subqueries in the plan."""
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, close, key, norm

SF = "/root/testdata/sf0.001"
#: Too long for a test; its parts are tested with small models in test_ml.
LONG = {"m13_compare_grid"}
NAMES = sorted(entry.queries())
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 15


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert len(set(re.findall(r"Subquery subquery#(\d+)", plan))) <= 2
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    rel = duck.sql(entry.oracle_sql()[name])
    dcols = list(rel.columns)
    assert sorted(dcols) == cols
    stypes = dict(sdf.dtypes)
    for c, t in zip(rel.columns, rel.types):
        assert DUCK_TYPES.get(str(t), str(t)) == stypes[c], (c, str(t), stypes[c])
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key)
    assert len(srows) == len(drows)
    assert all(close(a, b) for a, b in zip(srows, drows))


@pytest.mark.parametrize("name", [n for n in NAMES if n not in entry.oracle_sql()
                                  and n not in LONG])
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() >= 0
