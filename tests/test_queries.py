"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value if value is None or isinstance(value, (bool, int)) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, duck):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(plain(row[i]) for i in at) for row in relation.fetchall()), key=repr)
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row["total"] == row["kept"] > 0
