from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators import measures, star
from orderloom.operators.cleaning import clean
from orderloom.sources import sizing
from tests.lines import GOOD, line, text_lines


@pytest.fixture(scope="module")
def silver(spark):
    return clean(text_lines(
        spark,
        line(row_id="1", order_id="A", sales="100", profit="10", discount="0.1", quantity="1"),
        line(row_id="2", order_id="A", product_id="P2", category="Technology", sales="50", profit="-5",
             discount="0.3", quantity="2", ship_mode="Same Day"),
        line(row_id="3", order_id="B", order_date="2017-02-01", product_id="P2", category="Technology",
             sales="150", profit="0", discount="0.2", quantity="3", customer_id="C2", region="West"),
        line(row_id="4", order_id="C", order_date="2017-03-01", sales="200", profit="20", discount="0.0",
             quantity="4"),
    )).cache()


@pytest.fixture(scope="module")
def fact(silver):
    return star.fact_orders(silver).cache()


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_kpi_summary(fact):
    row = measures.kpi_summary(fact).first()
    assert (row.total_sales, row.total_profit, row.total_orders, row.total_quantity) == (500.0, 25.0, 3, 10)
    assert (row.profit_margin_pct, row.avg_order_value, row.avg_discount_pct) == (5.0, 166.6667, 15.0)


def test_kpi_profit_counts_rows(fact):
    assert measures.kpi_profit(fact).first().asDict() == {
        "total_profit": 25.0, "total_loss": -5.0, "profitable_orders": 2, "loss_orders": 1,
    }


def test_kpi_customer_and_product(silver, fact):
    row = measures.kpi_customer(fact).first()
    assert (row.total_customers, row.repeat_customers, row.avg_sales_per_customer) == (2, 1, 250.0)
    assert measures.kpi_product(star.dim_product(silver)).first().total_products == 2
    repeat = measures.repeat_customers(fact, star.dim_customer(silver)).collect()
    assert [(r.customer_id, r.distinct_orders) for r in repeat] == [("K-7", 2)]


def test_empty_fact_divides_by_nothing(fact):
    empty = fact.limit(0)
    summary = measures.kpi_summary(empty).first()
    assert (summary.total_sales, summary.profit_margin_pct, summary.avg_order_value) == (0.0, 0.0, 0.0)
    assert measures.kpi_customer(empty).first().avg_sales_per_customer == 0.0
    assert measures.kpi_profit(empty).first().total_loss == 0.0


def test_charts(silver, fact):
    products, regions, dates = star.dim_product(silver), star.dim_region(silver), star.dim_date(silver)
    by_category = measures.amounts_by(fact, products, "product_key", ["category"], "sales", "total_sales")
    assert rows(by_category, "category", "total_sales") == [("Seating", 300.0), ("Technology", 200.0)]
    assert rows(measures.with_share(by_category, "total_sales"), "category", "share_pct") == [
        ("Seating", 60.0), ("Technology", 40.0)
    ]
    by_region = measures.amounts_by(fact, regions, "region_key", ["region"], "profit", "total_profit")
    assert rows(by_region, "region", "total_profit") == [("Coast", 25.0), ("West", 0.0)]
    yearly = measures.amounts_by(fact, dates, "date_key", ["year"], "sales", "total_sales")
    assert [(r.year, r.growth_pct) for r in measures.with_growth(yearly).orderBy("year").collect()] == [
        (2016, None), (2017, 133.3333)
    ]
    assert rows(measures.orders_by_year(fact, dates), "year", "total_orders") == [(2016, 1), (2017, 2)]
    quantity = measures.quantity_by(fact, products, "product_key", "category")
    assert rows(quantity, "category", "total_quantity") == [("Seating", 5), ("Technology", 5)]
    assert rows(measures.amounts_by_ship_mode(fact), "ship_mode", "share_pct") == [
        ("Same Day", 10.0), ("Standard", 90.0)
    ]


def test_growth_is_against_the_year_before(spark):
    df = spark.createDataFrame([(2014, 50.0), (2015, 75.0), (2017, 10.0), (2018, 0.0), (2019, 4.0)],
                               "year INT, total_sales DOUBLE")
    growth = {r.year: r.growth_pct for r in measures.with_growth(df).collect()}
    assert growth == {2014: None, 2015: 50.0, 2017: None, 2018: -100.0, 2019: None}


def test_top_and_bottom_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "name STRING, v DOUBLE")
    assert [r.name for r in measures.top(df, "v", "name", 2).collect()] == ["c", "a"]
    assert [r.name for r in measures.bottom(df, "v", "name", 2).collect()] == ["a", "b"]


def test_top_members_names_only_what_it_found(silver, fact):
    found = measures.top_members(fact, star.dim_product(silver), "product_key", ["product_id"], 1)
    assert rows(found, "product_id", "total_sales") == [("CHA-77", 300.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan


def test_live_totals_count_lines(silver):
    totals = measures.category_region_totals(silver)
    furniture = totals.where("category = 'Seating'").first()
    assert (furniture.total_sales, furniture.total_orders, furniture.avg_discount) == (300.0, 2, 0.05)
    assert measures.live_totals(totals).first().asDict() == {
        "total_sales": 500.0, "total_orders": 4, "total_profit": 25.0
    }
    assert rows(measures.live_by(totals, "category"), "category", "total_sales") == [
        ("Seating", 300.0), ("Technology", 200.0)
    ]
    distinct = measures.distinct_orders_by_category_region(silver)
    assert rows(distinct, "category", "region", "distinct_orders") == [
        ("Seating", "Coast", 2), ("Technology", "Coast", 1), ("Technology", "West", 1)
    ]


def test_size_of_the_dimension_decides_the_plan_not_the_result(silver, fact, monkeypatch):
    def chart():
        return measures.amounts_by(
            fact, star.dim_product(silver), "product_key", ["category"], "sales", "total_sales"
        )

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    small, small_plan = sorted(chart().collect()), plan(chart())
    assert "Aggregate [category" in small_plan.split("Join", 1)[0] and "strategy=broadcast" in small_plan
    assert "Aggregate [product_key" not in small_plan
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    above, below = plan(chart()).split("Join", 1)
    assert "Aggregate [category" in above and "Aggregate [product_key" in below
    assert "strategy=broadcast" not in below
    assert sorted(chart().collect()) == small


def test_totals_are_exact(spark):
    cents = text_lines(spark, *[
        line(row_id=str(i), order_id=str(i), sales="0.10", profit="0.0001") for i in range(1000)
    ])
    row = measures.kpi_summary(star.fact_orders(clean(cents))).first()
    assert row.total_sales == 100.0 and row.total_profit == 0.1


def test_top_lists_are_in_order_and_whole(spark):
    fact = spark.createDataFrame(
        [(k, float(k % 7), k) for k in range(1, 30)] + [(99, 500.0, 0), (98, None, 0)], "product_key long, sales double, n int"
    ).withColumn("sales", F.col("sales").cast("decimal(18,4)"))
    products = spark.createDataFrame([(k, f"P{k:02d}") for k in range(1, 30)], "product_key long, product_id string")
    found = measures.top_members(fact, products, "product_key", ["product_id"], 6).collect()
    assert [(r.product_id, r.total_sales) for r in found] == [
        (None, 500.0), ("P06", 6.0), ("P13", 6.0), ("P20", 6.0), ("P27", 6.0), ("P05", 5.0)
    ]
    amounts = spark.createDataFrame([("a", None), ("b", 3.0), ("c", -1.0)], "name string, total double")
    assert [r.name for r in measures.bottom(amounts, "total", "name", 2).collect()] == ["c", "b"]
    assert [r.name for r in measures.top(amounts, "total", "name", 3).collect()] == ["b", "c", "a"]


def test_customer_figures_need_no_sort(spark):
    fact = spark.createDataFrame([(1, "a", 2)], "customer_key long, order_id string, sales int")
    assert "SortAggregate" not in measures.kpi_customer(fact)._jdf.queryExecution().toString()


def test_an_instant_shows_the_same_in_every_session_zone(spark):
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("last_updated"))
            assert measures.last_updated_ist(at).first()[0] == "01-01-1970 05:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
