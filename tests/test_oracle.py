"""Every catalog query against its DuckDB SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = os.environ.get("FEATUREFLOW_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(ROOT):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{ROOT}/{name}'")
    return connection


def values(rows, columns):
    def text(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(text(row[c]) for c in columns) for row in rows)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = [dict(zip(columns, row)) for row in result.fetchall()]
    assert values(df.collect(), sorted(columns)) == values(expected, sorted(columns))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["label", "n", "mean_0", "mean_1", "mean_2", "percent"]
    assert df.count() == 10
