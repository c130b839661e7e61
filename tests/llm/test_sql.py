"""Queries on training text against their SQL in an independent engine."""

from __future__ import annotations

import os

import duckdb
import pytest

from orderloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = QUERIES[name](spark, FOLDER)
    wanted = engine.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(wanted.fetchall(), key=repr)
