"""Every operator is registered, and those that SQL can express equal DuckDB."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from concord.llm import queries

SF01 = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    names = list(queries.QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF01):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF01}/{f}')")
    df = queries.QUERIES[name](spark, SF01)
    res = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, map(tuple, res.fetchall())))
