"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from paylens.llm.oracle import ORACLES
from paylens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    rows = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(rows.columns) == sorted(columns)
    assert sorted(map(tuple, rows.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
