"""Every registered query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in records), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = oracle.execute(ORACLES[name])
    wanted = rows([d[0] for d in relation.description], relation.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]
    assert wanted[1] or name in ("two_hop_sample",)


def test_queries_without_sql(spark):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
