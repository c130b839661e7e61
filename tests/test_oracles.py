"""Every registered query against its SQL in an independent engine."""

from __future__ import annotations

import os
from dataclasses import replace
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from checks.oracles import ORACLES
from orderloom.operators.cleaning import clean
from orderloom.plans.catalog import LAYER_QUERIES, all_queries, layers_of
from orderloom.schema import BATCH_V2, Rule

FOLDER = os.environ.get("ORDERLOOM_TEST_DATA", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(ORACLES)
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, sql, name):
    got = driver.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    wanted = sql.execute(driver.oracle_sql()[name])
    found = [d[0] for d in wanted.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in wanted.fetchall()), key=repr)
    actual = sorted((tuple(row[c] for c in columns) for row in got.collect()), key=repr)
    assert actual == expected
    assert expected or name.startswith("dq_")


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_the_sql_takes_nothing_from_the_library():
    source = (Path(driver.__file__).parent / "checks" / "oracles.py").read_text()
    assert "orderloom" not in source


def test_a_flipped_rule_turns_a_query_red(spark, sql, monkeypatch):
    rules = tuple(Rule(r.name, "sales < 0") if r.name == "negative_sales" else r for r in BATCH_V2.rules)
    monkeypatch.setitem(LAYER_QUERIES, "silver_v2", lambda t: clean(t.table("bronze"), replace(BATCH_V2, rules=rules)))
    got = LAYER_QUERIES["silver_v2"](layers_of(spark, FOLDER)).count()
    assert got != len(sql.execute(ORACLES["silver_v2"]).fetchall())
