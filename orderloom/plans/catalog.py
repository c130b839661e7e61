"""Every query by name, over the layers built from one folder of trade tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import ist_label
from orderloom.functions.keys import surrogate_key
from orderloom.operators import cleaning, forecast, measures, quality, star
from orderloom.plans.layers import Layers
from orderloom.schema import BATCH_V1, BATCH_V2, BROKEN_RECORD, DATE_FORMAT, ORDER_LINE_SCHEMA, STREAM
from orderloom.sources.files import read_order_records, rename_by_heading, rename_by_position
from orderloom.sources.folders import new_folder
from orderloom.sources.sizing import line_scan_bytes, sized_shuffles
from orderloom.sources.trade import csv_text, line_bytes, raw_order_lines, typed_order_lines
from orderloom.streaming import orders as streaming

# The Type 1 example refreshes the dimension of the orders before this day.
REFRESH_DAY = "1999-01-01"

# Files one micro-batch takes on per core: a backlog is worked off in steps that can be resumed,
# and each step keeps all cores busy.
FILES_PER_CORE = 2

# Codec of the CSV files; none of them is large enough to be split.
CSV_COMPRESSION = "gzip"

# Records per CSV file: a file with a line feed inside quotes is read by one task (some 25 MB of text).
RECORDS_PER_FILE = 125_000

Query = Callable[[SparkSession, str], DataFrame]

_layers: dict[tuple[str, str], Layers] = {}


def layers_of(spark: SparkSession, folder: str) -> Layers:
    """The layers of a folder, built once per application; see forget_layers if its files change."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _layers:
        _layers[key] = Layers(
            spark,
            lambda: raw_order_lines(spark, folder),
            new_folder(spark, "layers"),
            raw_bytes=lambda: line_bytes(spark, folder),
        )
    return _layers[key]


def forget_layers(folder: str | None = None) -> None:
    """Have the layers of a folder, or of all, built anew by the next query."""
    for key in [k for k in _layers if folder is None or k[1] == folder]:
        del _layers[key]


def shown(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, as reports show them."""
    decimals = {c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")}
    return df.withColumns(decimals) if decimals else df


def _from_csv(t: Layers) -> DataFrame:
    """The raw lines, written as CSV files with broken records in between and read back."""
    path = new_folder(t.spark, "csv")
    write = csv_text(t.table("bronze")).write.option("maxRecordsPerFile", RECORDS_PER_FILE)
    write.text(path, compression=CSV_COMPRESSION)
    return rename_by_heading(read_order_records(t.spark, path, header=False))


def csv_broken_lines(t: Layers) -> DataFrame:
    rows = quality.quarantine(_from_csv(t))
    return rows.where(F.col(BROKEN_RECORD).isNotNull()).select(BROKEN_RECORD, "reject_reason", "row_id")


# --- bronze and silver -----------------------------------------------------

def try_parse_date(t: Layers) -> DataFrame:
    return t.table("bronze").select(
        "row_id",
        F.col("order_date").alias("order_date_text"),
        F.try_to_date("order_date", DATE_FORMAT).alias("order_date"),
    )


def silver_not_null(t: Layers) -> DataFrame:
    rows = cleaning.prepared(t.table("bronze"))
    return shown(cleaning.without_null_keys(rows, ["order_id", "customer_id", "product_id", "sales"]))


def silver_dedup(t: Layers) -> DataFrame:
    return shown(cleaning.deduplicated(cleaning.prepared(t.table("bronze"))))


def dq_typed_quarantine(t: Layers) -> DataFrame:
    """Lines that come typed and lose a value on the way to silver's types."""
    rows = quality.quarantine(typed_order_lines(t.table("bronze")))
    return shown(rows.where("flaws <> ''").select("row_id", "sales", "quantity", "discount", "profit", "ship_date", "flaws"))


def stream_rules(t: Layers) -> DataFrame:
    return shown(streaming.cleaned_stream(t.table("arrivals")).drop("processed_at"))


def dq_validation(t: Layers, silver: str) -> DataFrame:
    """The second set of checks over what a cleaning profile let through."""
    return quality.rule_report(t.table(silver), BATCH_V2)


def layer_row_counts(t: Layers) -> DataFrame:
    names = ["bronze", "silver", "dim_date", "dim_customer", "dim_product", "dim_region", "fact_orders"]
    counts = [
        t.table(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("layer"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


# --- streaming -------------------------------------------------------------

def files_per_batch(spark: SparkSession) -> int:
    return FILES_PER_CORE * spark.sparkContext.defaultParallelism


def _stream_once(t: Layers) -> str:
    """Clean the arrivals as a stream of files; the path of the sink."""
    t.table("arrivals")
    sink = new_folder(t.spark, "stream-clean")
    lines = streaming.arriving_lines(t.spark, t.path("arrivals"), ORDER_LINE_SCHEMA, files_per_batch(t.spark))
    query = streaming.append_available(
        streaming.cleaned_stream(lines), sink, new_folder(t.spark, "checkpoint")
    )
    query.awaitTermination()
    return sink


def stream_silver(t: Layers) -> DataFrame:
    return shown(t.spark.read.parquet(_stream_once(t)).drop("processed_at"))


def stream_gold(t: Layers) -> DataFrame:
    """Live totals over what the cleaning stream has appended."""
    totals = new_folder(t.spark, "stream-totals")
    query = streaming.running_totals(
        t.spark, _stream_once(t), totals, new_folder(t.spark, "checkpoint"), files_per_batch(t.spark)
    )
    query.awaitTermination()
    return streaming.latest_totals(t.spark, totals).drop("last_updated")


def gold_category_region(t: Layers) -> DataFrame:
    return measures.category_region_totals(t.table("clean_arrivals"))


def live_last_updated(t: Layers) -> DataFrame:
    """The newest day of arrivals as the time of their live totals, in India time.

    The totals carry the clock's time when they are published; here they take one from the data.
    """
    newest = t.table("clean_arrivals").agg(F.max("order_date")).scalar().cast("timestamp")
    return measures.last_updated_ist(gold_category_region(t).withColumn("last_updated", newest))


# --- gold ------------------------------------------------------------------

def _star(t: Layers) -> list[DataFrame]:
    return [t.table(n) for n in ("dim_date", "dim_customer", "dim_product", "dim_region")]


def scd1_customer(t: Layers) -> DataFrame:
    silver = t.table("silver")
    before = star.dim_customer(silver.where(F.col("order_date") < REFRESH_DAY))
    return star.refreshed_customers(before, silver.where(F.col("order_date") >= REFRESH_DAY))


def _stored(t: Layers, rows: DataFrame, label: str) -> DataFrame:
    """Rows made from silver, written with shuffles sized for it, and read back."""
    path = new_folder(t.spark, label)
    with sized_shuffles(t.spark, line_scan_bytes(t.table("silver"))):
        rows.write.parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


def fact_keys_resolved(t: Layers) -> DataFrame:
    """Fact lines whose key no dimension holds, over customers that carry keys from elsewhere.

    The customers of the orders before REFRESH_DAY are numbered by an older system (here:
    the digest of a marked id), refreshed by the later orders, and the fact is built on them.
    """
    silver = t.table("silver")
    before = star.dim_customer(silver.where(F.col("order_date") < REFRESH_DAY))
    known = before.withColumn("customer_key", surrogate_key(F.concat(F.lit("old-"), "customer_id")))
    customers = _stored(t, star.refreshed_customers(known, silver.where(F.col("order_date") >= REFRESH_DAY)), "customers")
    # Written once: each dimension's check reads its own key, and none makes the fact again.
    fact = star.with_known_customers(star.fact_orders(silver), customers)
    fact = _stored(t, fact.select("date_key", "customer_key", "product_key", "region_key"), "fact-keys")
    dates, _, products, regions = _star(t)
    return star.unresolved_keys(fact, {
        "dim_date": (dates, "date_key"),
        "dim_customer": (customers, "customer_key"),
        "dim_product": (products, "product_key"),
        "dim_region": (regions, "region_key"),
    })


def _by(measure: str, dimension: str, *attributes: str) -> Callable[[Layers], DataFrame]:
    """A chart: one money measure by attributes of one dimension."""
    key = dimension.removeprefix("dim_") + "_key"

    def query(t: Layers) -> DataFrame:
        return measures.amounts_by(
            t.table("fact_orders"), t.table(dimension), key, attributes, measure, f"total_{measure}"
        )

    return query


def _share(amounts: Callable[[Layers], DataFrame], measure: str) -> Callable[[Layers], DataFrame]:
    return lambda t: measures.with_share(amounts(t), measure)


def orders_by_year(t: Layers) -> DataFrame:
    return measures.orders_by_year(t.table("fact_orders"), t.table("dim_date"))


sales_by_year = _by("sales", "dim_date", "year")
sales_by_category = _by("sales", "dim_product", "category")
sales_by_state = _by("sales", "dim_region", "region", "state")
profit_by_subcategory = _by("profit", "dim_product", "sub_category")
profit_by_segment = _by("profit", "dim_customer", "segment")


# --- trend and forecast ----------------------------------------------------

def monthly(t: Layers) -> DataFrame:
    return forecast.monthly_sales(t.table("fact_orders"), t.table("dim_date"))


def monthly_by_category(t: Layers) -> DataFrame:
    return forecast.monthly_sales_by(
        t.table("fact_orders"), t.table("dim_date"), t.table("dim_product"), "product_key", "category"
    )


def monthly_by_region(t: Layers) -> DataFrame:
    return forecast.monthly_sales_by(
        t.table("fact_orders"), t.table("dim_date"), t.table("dim_region"), "region_key", "region"
    )


def monthly_with_stream(t: Layers) -> DataFrame:
    return forecast.merged_months(monthly(t), forecast.monthly_stream(t.table("clean_arrivals")))


def model_r2(t: Layers) -> DataFrame:
    return forecast.model_quality(monthly(t), monthly_by_category(t), monthly_by_region(t))


def forecast_category(t: Layers, measure: str = "sales") -> DataFrame:
    return forecast.forecast_category(
        monthly_by_category(t), measure=measure, last=forecast.last_month(t.table("dim_date"))
    )


def forecast_region(t: Layers) -> DataFrame:
    return forecast.forecast_region(
        monthly_by_region(t), last=forecast.last_month(t.table("dim_date"))
    )


def forecast_rank(t: Layers) -> DataFrame:
    return forecast.forecast_rank(forecast_category(t), forecast_region(t))


def last_event_ist(spark: SparkSession, folder: str) -> DataFrame:
    """Latest event time, shown in India time; event times are UTC without zone."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.agg(F.max("ts").alias("ts")).select(ist_label(F.col("ts")).alias("last_updated_ist"))


LAYER_QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    # bronze
    "scan_order_lines": lambda t: t.table("bronze"),
    "bronze_rename": lambda t: rename_by_position(t.raw()),
    "try_parse_date": try_parse_date,
    "csv_whole_lines": lambda t: cleaning.whole_lines(_from_csv(t)),
    "csv_broken_lines": csv_broken_lines,
    # silver
    "silver_typed": lambda t: shown(cleaning.typed(t.table("bronze"))),
    "silver_trim": lambda t: cleaning.trimmed(t.table("bronze")),
    "silver_not_null": silver_not_null,
    "silver_dedup": silver_dedup,
    "silver_v1": lambda t: shown(cleaning.clean(t.table("bronze"), BATCH_V1)),
    "silver_v2": lambda t: shown(cleaning.clean(t.table("bronze"), BATCH_V2)),
    "dq_report": lambda t: quality.full_report(t.table("bronze")),
    "dq_validation_v1": lambda t: dq_validation(t, "silver_v1"),
    "dq_validation_v2": lambda t: dq_validation(t, "silver"),
    "dq_checks_passed_v1": lambda t: quality.validation_summary(dq_validation(t, "silver_v1")),
    "dq_step_counts": lambda t: quality.step_counts(t.table("bronze")),
    "dq_quarantine": lambda t: shown(quality.quarantine(t.table("bronze"))),
    "dq_quarantine_stream": lambda t: shown(quality.quarantine(t.table("bronze"), STREAM)),
    "dq_typed_flaws": lambda t: quality.flaw_report(typed_order_lines(t.table("bronze"))),
    "dq_typed_quarantine": dq_typed_quarantine,
    "dq_duplicate_keys": lambda t: quality.duplicate_keys(
        cleaning.valid(cleaning.prepared(t.table("bronze")))
    ),
    "stream_rules": stream_rules,
    "layer_row_counts": layer_row_counts,
    # star schema
    "dim_date": lambda t: star.dim_date(t.table("silver")),
    "dim_customer": lambda t: star.dim_customer(t.table("silver")),
    "dim_product": lambda t: star.dim_product(t.table("silver")),
    "dim_region": lambda t: star.dim_region(t.table("silver")),
    "fact_orders": lambda t: shown(star.fact_orders(t.table("silver"))),
    "fact_orders_joined": lambda t: shown(star.fact_orders_joined(t.table("silver"), *_star(t))),
    "fact_enriched": lambda t: shown(star.fact_enriched(t.table("fact_orders"), *_star(t))),
    "scd1_customer": scd1_customer,
    "fact_keys_resolved": fact_keys_resolved,
    # key figures
    "kpi_summary": lambda t: measures.kpi_summary(t.table("fact_orders")),
    "kpi_profit": lambda t: measures.kpi_profit(t.table("fact_orders")),
    "kpi_customer": lambda t: measures.kpi_customer(t.table("fact_orders")),
    "kpi_product": lambda t: measures.kpi_product(t.table("dim_product")),
    "repeat_customers": lambda t: measures.repeat_customers(
        t.table("fact_orders"), t.table("dim_customer")
    ),
    # charts
    "sales_by_region": _by("sales", "dim_region", "region"),
    "category_share": _share(sales_by_category, "total_sales"),
    "sales_by_month": _by("sales", "dim_date", "month", "month_name"),
    "sales_by_subcategory": _by("sales", "dim_product", "sub_category"),
    "ship_mode_share": lambda t: measures.amounts_by_ship_mode(t.table("fact_orders")),
    "sales_by_year": lambda t: measures.with_growth(sales_by_year(t)),
    "top_states": lambda t: measures.top(sales_by_state(t), "total_sales", "state", 5),
    "profit_by_subcategory": profit_by_subcategory,
    "most_profitable_subcategories": lambda t: measures.top(
        profit_by_subcategory(t), "total_profit", "sub_category", 5
    ),
    "least_profitable_subcategories": lambda t: measures.bottom(
        profit_by_subcategory(t), "total_profit", "sub_category", 5
    ),
    "profit_by_region": _by("profit", "dim_region", "region"),
    "profit_by_year": _by("profit", "dim_date", "year"),
    "profit_by_category": _by("profit", "dim_product", "category"),
    "sales_by_segment": _by("sales", "dim_customer", "segment"),
    "top_customers": lambda t: measures.top_members(
        t.table("fact_orders"), t.table("dim_customer"), "customer_key", ["customer_id", "customer_name"], 5
    ),
    "orders_by_year": orders_by_year,
    "segment_profit_share": _share(profit_by_segment, "total_profit"),
    "top_products": lambda t: measures.top_members(
        t.table("fact_orders"), t.table("dim_product"), "product_key", ["product_id", "product_name"], 5
    ),
    "quantity_by_subcategory": lambda t: measures.quantity_by(
        t.table("fact_orders"), t.table("dim_product"), "product_key", "sub_category"
    ),
    # streaming and live totals
    "stream_silver": stream_silver,
    "stream_gold": stream_gold,
    "gold_category_region": gold_category_region,
    "distinct_orders_category_region": lambda t: measures.distinct_orders_by_category_region(
        t.table("clean_arrivals")
    ),
    "live_totals": lambda t: measures.live_totals(gold_category_region(t)),
    "live_last_updated": live_last_updated,
    "live_by_category": lambda t: measures.live_by(gold_category_region(t), "category"),
    "live_by_region_category": lambda t: measures.live_by(
        gold_category_region(t), "region", "category"
    ),
    # trend and forecast
    "monthly_sales": monthly,
    "monthly_sales_by_category": monthly_by_category,
    "monthly_sales_by_region": monthly_by_region,
    "stream_month_total": lambda t: measures.live_totals(
        forecast.monthly_stream(t.table("clean_arrivals"))
    ),
    "monthly_stream": lambda t: forecast.monthly_stream(t.table("clean_arrivals")),
    "monthly_with_stream": monthly_with_stream,
    "trend_model": lambda t: forecast.trend_table(forecast.trend(monthly(t))),
    "trend_model_by_category": lambda t: forecast.trend_table(
        forecast.trend(monthly_by_category(t), ["category"]), ["category"]
    ),
    "trend_model_by_region": lambda t: forecast.trend_table(
        forecast.trend(monthly_by_region(t), ["region"]), ["region"]
    ),
    "future_months": lambda t: forecast.future_months(monthly(t)),
    "forecast_overall": lambda t: forecast.forecast_overall(monthly(t)),
    "forecast_with_stream": lambda t: forecast.forecast_overall(monthly_with_stream(t)),
    "forecast_category": forecast_category,
    "forecast_category_profit": lambda t: forecast_category(t, "profit"),
    "forecast_region": forecast_region,
    "model_r2": model_r2,
    "forecast_rank": forecast_rank,
}


def all_queries() -> dict[str, Query]:
    def over_layers(query: Callable[[Layers], DataFrame]) -> Query:
        return lambda spark, folder: query(layers_of(spark, folder))

    named = {name: over_layers(query) for name, query in LAYER_QUERIES.items()}
    return {**named, "last_event_ist": last_event_ist}
