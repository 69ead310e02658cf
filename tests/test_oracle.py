"""Every registered query against its SQL counterpart, on whole tables."""

import glob
import os

import duckdb
import pytest
from helpers import rows_of

import __spark_entry__ as entry
from quotegrid.suite.oracle import ORACLE_SQL as SQL
from quotegrid.suite.queries import QUERIES



@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in plan
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in sorted(names)]
    expected = sorted(tuple(str(row[i]) for i in order) for row in result.fetchall())
    assert rows_of(got) == expected and expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
