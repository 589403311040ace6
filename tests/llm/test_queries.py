import os
import sys

import duckdb
import pytest

from zonecast.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
TABLES = ("documents", "pages", "labels", "benchmark", "embeddings")


def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_oracle(spark, name, sf):
    df = QUERIES[name](spark, sf)
    want = duck(sf).sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    at = [want.columns.index(c) for c in order]
    rows = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
    assert rows == sorted(tuple(str(r[i]) for i in at) for r in want.fetchall())


def test_all_queries():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
