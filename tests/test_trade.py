from __future__ import annotations

import datetime

import pytest

from orderloom.sources.trade import raw_order_lines

DAY = datetime.datetime(1997, 3, 4)

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "NORTH")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ICE", 0), (1, "SNOW", None)]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(1, "Ada", 0, 1.0, "TOOLS"), (2, "Bo", 1, 2.0, None), (3, None, None, 3.0, "TOYS")],
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(5, "bolt", "B1", "STEEL", 1, 9.0), (6, "nut", "B2", None, 2, 8.0), (6, "nut again", "B2", "TIN", 2, 8.0)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(10, 1, "P", 1.0, DAY, "1"), (11, 2, "O", 1.0, DAY, None), (11, 3, "O", 1.0, DAY, "2"), (None, 1, "P", 1.0, None, "3")],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [
            (10, 5, 1, 1, 17.0, 100.25, 0.04, 0.01, "R", "O", DAY),
            (10, 6, 1, 2, 23.0, 7.5, 0.1, 0.03, "N", "O", DAY.replace(hour=9)),
            (11, 5, 1, 1, 29.0, 0.1, 0.0, 0.035, None, "F", None),
            (11, None, 1, 3, 43.0, None, None, None, "R", "F", DAY),
            (12, 7, 1, 1, 43.0, 3.0, 0.02, 0.0, "A", "F", DAY),
            (None, 6, 1, 1, 37.0, 3.0, 0.02, 0.0, "R", "F", DAY),
        ],
    ),
}


@pytest.fixture()
def folder(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def joins(rows):
    """Keys of the joins in the plan, the last one first."""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    return [next(k for k in ("l_partkey", "l_orderkey", "o_custkey", "c_nationkey", "n_regionkey") if k in row)
            for row in plan.splitlines() if "Join LeftOuter" in row], plan


def test_large_parts_meet_the_lines_before_orders_make_them_wide(spark, folder, no_broadcast):
    small = raw_order_lines(spark, folder)
    expected = sorted(small.collect(), key=repr)
    assert joins(small)[0][:2] == ["l_partkey", "l_orderkey"] and len(expected) == 10
    no_broadcast()
    large = raw_order_lines(spark, folder)
    assert joins(large)[0][:2] == ["l_orderkey", "l_partkey"]
    assert sorted(large.collect(), key=repr) == expected


def test_lines_are_shuffled_without_texts_and_times(spark, folder, no_broadcast):
    no_broadcast()
    plan = raw_order_lines(spark, folder)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Filter" and not plan.children().isEmpty():
        lines, plan = plan, plan.children().head()
    types = {lines.output().apply(i).name(): lines.output().apply(i).dataType().simpleString() for i in range(lines.output().size())}
    assert not {"string", "timestamp_ntz"} & set(types.values()) and types["l_extendedprice"] == "decimal(18,2)"


def test_numbers_and_texts_are_shuffled_as_one_column_each(spark, folder, no_broadcast):
    no_broadcast()
    plan = raw_order_lines(spark, folder)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    lines, orders = plan.children().head(), plan.children().last()
    names = lambda side: {side.output().apply(i).name() for i in range(side.output().size())}
    assert {"_line_numbers", "_line_rest", "_part_texts", "_part_rest"} < names(lines)
    assert names(orders) == {"o_orderkey", "c_custkey", "_order_numbers", "_order_texts", "_order_rest"}
    assert not {"l_quantity", "l_shipdate", "p_name", "p_type"} & names(lines)
