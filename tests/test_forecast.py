from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from orderloom.functions.dates import index_month, index_year, ist_label, month_label
from orderloom.operators import forecast, star
from orderloom.operators.cleaning import clean
from orderloom.sources import sizing
from tests.lines import line, text_lines

SERIES = (
    "year INT, month INT, total_sales DOUBLE, total_profit DOUBLE, total_orders BIGINT, month_index BIGINT"
)


def series(spark, values, year=2017, month=1):
    rows = []
    for i, v in enumerate(values):
        y, m = divmod(year * 12 + month - 1 + i, 12)
        rows.append((y, m + 1, float(v), v / 10, 10 + i, (y - 2015) * 12 + m + 1))
    return spark.createDataFrame(rows, SERIES)


@pytest.fixture(scope="module")
def lines(spark):
    return clean(text_lines(
        spark,
        line(row_id="1", order_id="A", order_date="2016-11-01", sales="100", profit="1"),
        line(row_id="2", order_id="B", order_date="2016-11-20", sales="20", profit="2", product_id="P2", category="Tech"),
        line(row_id="3", order_id="C", order_date="2016-12-31", sales="300", profit="3"),
        line(row_id="4", order_id="D", order_date="2017-01-01", sales="500", profit="5"),
    )).cache()


def test_month_labels_for_any_index(spark):
    df = spark.sql("SELECT explode(sequence(-25L, 150L)) AS i")
    got = df.select("i", index_year(F.col("i")).alias("y"), index_month(F.col("i")).alias("m"),
                    month_label(F.col("i")).alias("label")).collect()
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    for r in got:
        year, month = divmod(2015 * 12 + r.i - 1, 12)
        assert (r.y, r.m, r.label) == (year, month + 1, f"{names[month]} {year}")


def test_ist_label(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-07-31 20:45:10' AS ts")
    assert df.select(ist_label(F.col("ts")).alias("t")).first().t == "01-08-2026 02:15:10"
    zoned = spark.sql("SELECT timestamp'2026-07-31 20:45:10' AS ts")
    assert zoned.select(ist_label(F.col("ts")).alias("t")).first().t == "01-08-2026 02:15:10"


def test_monthly_series(lines):
    fact, dates = star.fact_orders(lines), star.dim_date(lines)
    months = {r.month_index: r for r in forecast.monthly_sales(fact, dates).collect()}
    assert set(months) == {23, 24, 25}
    assert (months[23].total_sales, months[23].total_profit, months[23].total_orders) == (120.0, 3.0, 2)
    by_category = forecast.monthly_sales_by(fact, dates, star.dim_product(lines), "product_key", "category")
    assert {(r.category, r.month_index): r.total_sales for r in by_category.collect()} == {
        ("Seating", 23): 100.0, ("Tech", 23): 20.0, ("Seating", 24): 300.0, ("Seating", 25): 500.0,
    }


def test_large_dimensions_give_the_same_series(lines, monkeypatch):
    fact, dates, products = star.fact_orders(lines), star.dim_date(lines), star.dim_product(lines)

    def series_by_category():
        return sorted(forecast.monthly_sales_by(fact, dates, products, "product_key", "category").collect())

    small = series_by_category()
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    assert series_by_category() == small
    assert forecast.monthly_sales(fact, dates).count() == 3


def test_lines_meet_a_large_dimension_in_parts_of_their_own(lines, monkeypatch):
    """By key and month hardly two lines add up: their measures are moved once, in as many parts as they need."""
    fact, dates, products = star.fact_orders(lines), star.dim_date(lines), star.dim_product(lines)
    fact = fact.unionByName(fact.limit(1).withColumn("product_key", F.lit(None).cast("long")))
    expected = sorted(forecast.monthly_sales_by(fact, dates, products, "product_key", "category").collect(), key=repr)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(forecast, "partitions_for", lambda size, least: 7, raising=False)
    found = forecast.monthly_sales_by(fact, dates, products, "product_key", "category")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [product_key" not in plan
    assert any("RepartitionByExpression [product_key" in row and row.endswith(", 7") for row in plan.splitlines())
    assert sorted(found.collect(), key=repr) == expected


def test_line_without_a_date_is_left_out_of_the_trend(lines):
    undated = lines.withColumn("order_date", F.when(F.col("row_id") != 4, F.col("order_date")))
    monthly = forecast.monthly_sales(star.fact_orders(undated), star.dim_date(lines))
    assert {r.month_index for r in monthly.collect()} == {23, 24}


def test_same_line_as_mllib(spark):
    monthly = series(spark, np.random.default_rng(3).normal(1000, 200, 48).round(2).tolist())
    model = forecast.trend(monthly).first()
    data = VectorAssembler(inputCols=["month_index"], outputCol="features").transform(monthly)
    for column, label in forecast.MEASURES.items():
        fitted = LinearRegression(featuresCol="features", labelCol=column).fit(data)
        assert model[f"{label}_slope"] == pytest.approx(fitted.coefficients[0], rel=1e-9)
        assert model[f"{label}_intercept"] == pytest.approx(fitted.intercept, rel=1e-9)
        assert model[f"{label}_r2"] == pytest.approx(fitted.summary.r2, rel=1e-9)


def test_forecast_crosses_the_year(spark):
    monthly = series(spark, [100 + 10 * i for i in range(11)])
    rows = forecast.forecast_overall(monthly).orderBy("month_index").collect()
    assert [r.month_name for r in rows] == ["Dec 2017", "Jan 2018", "Feb 2018"]
    assert [(r.year, r.month) for r in rows] == [(2017, 12), (2018, 1), (2018, 2)]
    assert [r.predicted_sales for r in rows] == [210.0, 220.0, 230.0]
    assert [r.predicted_profit for r in rows] == [21.0, 22.0, 23.0]
    assert [r.predicted_orders for r in rows] == [21, 22, 23]
    assert {r.data_type for r in rows} == {"Forecast"}
    assert [r.month_name for r in forecast.future_months(monthly).orderBy("month_index").collect()] == [
        "Dec 2017", "Jan 2018", "Feb 2018"
    ]


def test_groups_are_forecast_together_for_the_same_months(spark):
    a = series(spark, [100, 110, 120]).withColumn("category", F.lit("A"))
    b = series(spark, [50, 40]).withColumn("category", F.lit("B"))
    single = series(spark, [7]).withColumn("category", F.lit("one month"))
    rows = forecast.forecast_category(a.unionByName(b).unionByName(single)).collect()
    got = {(r.category, r.month_name): r.predicted_sales for r in rows}
    assert got == {
        ("A", "Apr 2017"): 130.0, ("A", "May 2017"): 140.0, ("A", "Jun 2017"): 150.0,
        ("B", "Apr 2017"): 20.0, ("B", "May 2017"): 10.0, ("B", "Jun 2017"): 0.0,
    }


def test_single_month_and_empty_series_give_no_forecast(spark):
    assert forecast.forecast_overall(series(spark, [5])).count() == 0
    assert forecast.forecast_overall(series(spark, [5]).limit(0)).count() == 0
    assert forecast.future_months(series(spark, [5]).limit(0)).count() == 0


def test_stream_months_add_to_the_series(lines):
    history = forecast.monthly_sales(star.fact_orders(lines), star.dim_date(lines))
    stream = forecast.monthly_stream(lines.where("row_id = 4").withColumn("order_date", F.lit("2017-02-03").cast("date")))
    merged = {r.month_index: r.total_sales for r in forecast.merged_months(history, stream).collect()}
    assert merged == {23: 120.0, 24: 300.0, 25: 500.0, 26: 500.0}
    doubled = {r.month_index: r.total_orders for r in forecast.merged_months(history, history).collect()}
    assert doubled == {23: 4, 24: 2, 25: 2}


def test_last_month_comes_from_the_calendar(spark, lines):
    by_category = forecast.monthly_sales_by(
        star.fact_orders(lines), star.dim_date(lines), star.dim_product(lines), "product_key", "category"
    )
    plain = forecast.forecast_category(by_category)
    quick = forecast.forecast_category(by_category, last=forecast.last_month(star.dim_date(lines)))
    assert sorted(plain.collect()) == sorted(quick.collect())


def test_model_quality_and_rank(spark):
    overall = series(spark, [100, 120, 110, 160])
    a = overall.withColumn("category", F.lit("A"))
    b = series(spark, [10, 9, 8]).withColumn("category", F.lit("B"))
    categories = a.unionByName(b)
    regions = categories.withColumnRenamed("category", "region")
    quality = {(r.kind, r.name, r.measure): (r.r2, r.months)
               for r in forecast.model_quality(overall, categories, regions).collect()}
    assert len(quality) == 3 + 2 + 2
    assert quality["category", "B", "sales"] == (1.0, 3)
    assert quality["overall", "all", "sales"] == quality["region", "A", "sales"]
    rank = forecast.forecast_rank(forecast.forecast_category(categories), forecast.forecast_region(regions))
    first = {(r.kind, r.name) for r in rank.where("sales_rank = 1").collect()}
    assert first == {("category", "A"), ("region", "A")}


def test_lines_do_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [
        (f"g{g}", 2015 + m // 12, m % 12 + 1, float(v), float(-v / 7), int(n), m + 1)
        for g in range(4) for m, (v, n) in enumerate(zip(rng.lognormal(14, 2, 90), rng.integers(0, 10**6, 90)))
    ]
    frame = spark.createDataFrame(rows, "g STRING, " + SERIES)
    def fitted(partitions):
        return sorted(tuple(r) for r in forecast.trend(frame.repartition(partitions, "month_index"), ["g"]).collect())

    assert fitted(1) == fitted(200) == fitted(7)
    by_group = {g: [r for r in rows if r[0] == g] for g in ("g0", "g3")}
    columns = forecast.trend(frame, ["g"]).columns
    for r in fitted(3):
        found = dict(zip(columns, r))
        assert 0 <= found["sales_r2"] <= 1 and 0 <= found["orders_r2"] <= 1
        if r[0] in by_group:
            x, y = (np.array([row[k] for row in by_group[r[0]]], float) for k in (6, 3))
            slope, start = np.polyfit(x, y, 1)
            assert found["sales_slope"] == pytest.approx(slope, rel=1e-7) and found["sales_intercept"] == pytest.approx(start, rel=1e-7)
            assert found["sales_r2"] == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2, rel=1e-7)


def test_flat_and_missing_measures(spark):
    flat = [(2015, m, 5.0, None if m < 3 else 1.0 * m, 7, m) for m in range(1, 7)] + [(2016, 1, None, None, None, 13)]
    found = forecast.trend(spark.createDataFrame(flat, SERIES)).first()
    assert (found.sales_slope, found.sales_intercept, found.sales_r2, found.months) == (0.0, 5.0, 1.0, 7)
    assert found.profit_slope == pytest.approx(1) and found.profit_r2 == pytest.approx(1)
    lone = [(2015, 1, 5.0, 1.0, None, 1), (2015, 2, 6.0, None, None, 2)]
    found = forecast.trend(spark.createDataFrame(lone, SERIES)).first()
    assert found.sales_slope == 1.0 and found.profit_slope is None and found.orders_r2 is None
