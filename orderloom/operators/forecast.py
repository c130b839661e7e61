"""Monthly trend and straight-line forecasts, for all groups in one plan.

A least-squares line on one feature is a handful of sums, so every category or
region is fitted in the same grouped query: nothing is looped over or brought to
the driver. The sums are decimals, so they do not depend on the order in which
partitions merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.dates import index_month, index_year, month_index, month_label
from orderloom.operators.measures import per_member
from orderloom.sources.sizing import PARTITIONS_SETTING, line_scan_bytes, partitions_for

HORIZON = 3

# Measures of the trend: column of the monthly series and its short label.
MEASURES = {"total_sales": "sales", "total_profit": "profit", "total_orders": "orders"}


def _line_sums() -> dict[str, Column]:
    """What an order line adds to its month; total_orders counts lines."""
    return {
        "total_sales": F.col("sales"),
        "total_profit": F.col("profit"),
        "total_orders": F.when(F.col("order_id").isNotNull(), 1).otherwise(0),
    }


def _finished(sums: DataFrame, groups: Sequence[str]) -> DataFrame:
    return sums.select(
        *groups,
        "year",
        "month",
        F.round("total_sales", 2).cast("double").alias("total_sales"),
        F.round("total_profit", 2).cast("double").alias("total_profit"),
        F.col("total_orders").cast("long").alias("total_orders"),
        month_index(F.col("year"), F.col("month")).alias("month_index"),
    ).orderBy(*groups, "month_index")


def monthly_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales, profit and order lines per month; lines without a date are left out."""
    dated = fact.where("date_key IS NOT NULL")
    return _finished(per_member(dated, dates, "date_key", ["year", "month"], _line_sums()), [])


def monthly_sales_by(
    fact: DataFrame, dates: DataFrame, dimension: DataFrame, key: str, group: str
) -> DataFrame:
    """The monthly series of every category or region.

    Dates are looked up first: a calendar is small, so this moves no lines. A dimension too large
    to broadcast moves the measures of the lines, in as many parts as their size asks for.
    """
    partitions = partitions_for(line_scan_bytes(fact), int(fact.sparkSession.conf.get(PARTITIONS_SETTING)))
    dated = fact.where("date_key IS NOT NULL").join(
        dates.select("date_key", "year", "month"), "date_key", "left"
    )
    return _finished(
        per_member(dated, dimension, key, [group], _line_sums(), ["year", "month"], partitions), [group]
    )


def monthly_stream(clean_lines: DataFrame) -> DataFrame:
    """The monthly series of streamed orders, each in the month it was placed."""
    by_month = clean_lines.groupBy(
        F.year("order_date").alias("year"), F.month("order_date").alias("month")
    ).agg(*[F.sum(c).alias(name) for name, c in _line_sums().items()])
    return _finished(by_month, [])


def merged_months(*series: DataFrame) -> DataFrame:
    """Several monthly series as one: same months add up, others line up by name."""
    union = series[0]
    for other in series[1:]:
        union = union.unionByName(other)
    return union.groupBy("year", "month", "month_index").agg(
        _exact_sum("total_sales").alias("total_sales"),
        _exact_sum("total_profit").alias("total_profit"),
        F.sum("total_orders").alias("total_orders"),
    ).orderBy("month_index")


def _exact_sum(column: str) -> Column:
    """Amounts to the cent, added up as decimals so that the order does not matter."""
    return F.sum(F.col(column).cast("decimal(30,2)")).cast("double")


# Types of the exact sums: a product of two of them has 38 digits, the most a decimal has.
_VALUE, _COUNT, _TIMES, _SUM, _CROSS = "decimal(24,6)", "decimal(10,0)", "decimal(12,0)", "decimal(25,6)", "decimal(27,6)"


def _fit_sums(measure: str, label: str) -> list[Column]:
    """n, sums of x, y, x², xy and y², least and largest y over the months that have the measure."""
    y = F.col(measure).cast(_VALUE)
    x = F.when(y.isNotNull(), F.col("month_index"))
    sums = {
        "n": F.count(y),
        "x": F.sum(x),
        "xx": F.sum(x * x),
        "y": F.sum(y),
        "xy": F.sum(x.cast(_COUNT) * y),
        "yy": F.sum(y * y),
        "least": F.min(y),
        "most": F.max(y),
    }
    return [c.alias(f"_{label}_{name}") for name, c in sums.items()]


def _fit(label: str) -> list[Column]:
    """Slope, intercept and R² in closed form; null without two different months."""
    n, x, xx, y, xy, yy, least, most = (
        F.col(f"_{label}_{name}") for name in ("n", "x", "xx", "y", "xy", "yy", "least", "most")
    )
    spread = F.nullif(n * xx - x * x, F.lit(0))
    rise = n.cast(_COUNT) * xy.cast(_CROSS) - x.cast(_TIMES) * y.cast(_SUM)
    start = xx.cast(_TIMES) * y.cast(_SUM) - x.cast(_COUNT) * xy.cast(_CROSS)
    scatter = n * yy.cast("double") - y.cast("double") * y.cast("double")
    share = F.least(F.lit(1.0), rise.cast("double") * rise.cast("double") / (spread * F.greatest(scatter, F.lit(1e-300))))
    return [
        (rise.cast("double") / spread).alias(f"{label}_slope"),
        (start.cast("double") / spread).alias(f"{label}_intercept"),
        F.when(spread.isNotNull(), F.when(least == most, F.lit(1.0)).otherwise(share)).alias(f"{label}_r2"),
    ]


def trend(monthly: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R² of every measure, per group.

    Groups with a single month have no line and are left out. The normal equations are made
    of exact sums, amounts counting to six decimals, and solved once per group: the same lines
    to the last bit however the months are dealt over partitions.
    """
    sums = [c for measure, label in MEASURES.items() for c in _fit_sums(measure, label)]
    return (
        monthly.where("month_index IS NOT NULL")
        .groupBy(*groups)
        .agg(
            *sums,
            F.count("*").alias("months"),
            F.min("month_index").alias("first_index"),
            F.max("month_index").alias("last_index"),
        )
        .where("first_index < last_index")
        .select(*groups, *[c for label in MEASURES.values() for c in _fit(label)], "months", "last_index")
    )


def trend_table(model: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The fitted lines, rounded for display."""
    columns = []
    for label in MEASURES.values():
        columns += [
            F.round(f"{label}_slope", 4).alias(f"{label}_slope"),
            F.round(f"{label}_intercept", 2).alias(f"{label}_intercept"),
        ]
    return model.select(*groups, *columns, "months")


def _checked(horizon: int) -> int:
    if horizon < 1:
        raise ValueError(f"a forecast needs at least one month ahead, not {horizon}")
    return horizon


def future_months(monthly: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The next months after the last one of the series, in order."""
    _checked(horizon)
    last = monthly.agg(F.max("month_index").alias("last"))
    return last.where("last IS NOT NULL").select(
        F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon)).alias("month_index")
    ).select(
        "month_index",
        index_year(F.col("month_index")).alias("year"),
        index_month(F.col("month_index")).alias("month"),
        month_label(F.col("month_index")).alias("month_name"),
    )


def last_month(dates: DataFrame) -> Column:
    """Index of the last month of the date dimension, as a scalar subquery.

    The last month of the fact it belongs to, without reading the fact.
    """
    index = month_index(F.col("year"), F.col("month"))
    return dates.agg(F.max(index)).scalar()


def _predicted(label: str, digits: int = 2) -> Column:
    line = F.col(f"{label}_intercept") + F.col(f"{label}_slope") * F.col("month_index")
    return F.round(line, digits)


def _ahead(model: DataFrame, last_index: Column, horizon: int) -> DataFrame:
    return model.withColumn(
        "month_index", F.explode(F.sequence(last_index + 1, last_index + _checked(horizon)))
    )


def forecast_overall(monthly: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Sales, profit and orders of the next months."""
    model = trend(monthly)
    index = F.col("month_index")
    return _ahead(model, F.col("last_index"), horizon).select(
        "month_index",
        _predicted("sales").alias("predicted_sales"),
        _predicted("profit").alias("predicted_profit"),
        _predicted("orders", 0).cast("int").alias("predicted_orders"),
        index_year(index).alias("year"),
        index_month(index).alias("month"),
        month_label(index).alias("month_name"),
        F.lit("Forecast").alias("data_type"),
    ).orderBy("month_index")


def forecast_by(
    monthly: DataFrame,
    group: str,
    data_type: str,
    measure: str = "sales",
    horizon: int = HORIZON,
    last: Column | None = None,
) -> DataFrame:
    """One measure of the next months per group.

    All groups are forecast for the same months: those after last, by default
    the last month of any group in the series.
    """
    if last is None:
        last = monthly.agg(F.max("month_index")).scalar()
    return _ahead(trend(monthly, [group]), last, horizon).select(
        "month_index",
        _predicted(measure).alias(f"predicted_{measure}"),
        group,
        month_label(F.col("month_index")).alias("month_name"),
        F.lit(data_type).alias("data_type"),
    ).orderBy(group, "month_index")


def forecast_category(monthly_by_category: DataFrame, **options) -> DataFrame:
    return forecast_by(monthly_by_category, "category", "Category Forecast", **options)


def forecast_region(monthly_by_region: DataFrame, **options) -> DataFrame:
    return forecast_by(monthly_by_region, "region", "Region Forecast", **options)


def model_quality(
    overall: DataFrame, by_category: DataFrame, by_region: DataFrame
) -> DataFrame:
    """R² and number of months of every model, from the three monthly series."""
    def lines(model: DataFrame, kind: str, group, labels: Sequence[str]) -> DataFrame:
        rows = [
            F.struct(
                F.lit(kind).alias("kind"),
                group.alias("name"),
                F.lit(label).alias("measure"),
                F.round(f"{label}_r2", 6).alias("r2"),
                F.col("months"),
            )
            for label in labels
        ]
        return model.select(F.inline(F.array(*rows)))

    return (
        lines(trend(overall), "overall", F.lit("all"), list(MEASURES.values()))
        .unionByName(lines(trend(by_category, ["category"]), "category", F.col("category"), ["sales"]))
        .unionByName(lines(trend(by_region, ["region"]), "region", F.col("region"), ["sales"]))
    )


def forecast_rank(by_category: DataFrame, by_region: DataFrame) -> DataFrame:
    """Categories and regions by predicted sales, month by month."""
    both = by_category.select(
        F.lit("category").alias("kind"), F.col("category").alias("name"), "month_index", "predicted_sales"
    ).unionByName(by_region.select(
        F.lit("region").alias("kind"), F.col("region").alias("name"), "month_index", "predicted_sales"
    ))
    order = Window.partitionBy("kind", "month_index").orderBy(F.col("predicted_sales").desc(), "name")
    return both.withColumn("sales_rank", F.row_number().over(order).cast("long"))
