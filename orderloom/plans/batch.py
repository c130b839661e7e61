"""One batch run: raw lines to published bronze, silver and gold tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.functions.keys import key_clashes
from orderloom.operators import forecast
from orderloom.operators.star import unresolved_keys
from orderloom.plans.layers import Layers
from orderloom.schema import BATCH_V2, Profile
from orderloom.sources.tables import (
    Switch,
    recover_switches,
    scan,
    scan_if_exists,
    switch_tables,
    use_database,
    write_files,
)

BATCH_LAYERS = (
    "bronze", "silver", "dim_date", "dim_customer", "dim_product", "dim_region", "fact_orders",
)
DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_region": "region_key",
}


class BatchCounts(dict):
    """Rows of every layer, by name.

    steps: rows before, removed by and after each cleaning step; flaws: lines that lost a
    value in typing, by way. Both are counted while bronze is written.
    """

    steps: list[dict]
    flaws: dict[str, int]


def run_batch(
    spark: SparkSession,
    raw: Callable[[], DataFrame],
    root: str,
    database: str,
    profile: Profile = BATCH_V2,
) -> BatchCounts:
    """Write all layers under a new folder of root, then switch the tables to it.

    A run that fails, also while it switches tables, leaves them as they were, and can
    simply be started again; one that is killed there leaves a journal under root, by which
    the next run first puts them right. An earlier customer dimension is refreshed (Type 1), not replaced.
    Returns the row count of every layer, with the counts of the cleaning steps.
    """
    use_database(spark, database)
    recover_switches(spark, root)
    layers = Layers(
        spark,
        raw,
        f"{root.rstrip('/')}/run-{uuid.uuid4().hex}",
        profile,
        known_customers=scan_if_exists(spark, f"{database}.dim_customer"),
        fact_by_year=True,
        count_steps=True,
    )
    layers.resolve_clashes()
    counts = BatchCounts({name: layers.row_count(name) for name in BATCH_LAYERS})
    counts.steps, counts.flaws = layers.steps(), layers.flaws()
    if counts["fact_orders"] != counts["silver"]:
        raise RuntimeError(f"fact rows differ from silver rows: {counts}")
    for name, key in DIMENSION_KEYS.items():
        if not key_clashes(layers.table(name), key).isEmpty():
            raise RuntimeError(f"two members of {name} share a key")
    dimensions = {name: (layers.table(name), key) for name, key in DIMENSION_KEYS.items()}
    lost = unresolved_keys(layers.table("fact_orders"), dimensions).where("unresolved_lines > 0").collect()
    if lost:
        raise RuntimeError(f"fact keys that no dimension holds: {[tuple(r) for r in lost]}")
    switch_tables(spark, [
        Switch(f"{database}.{name}", layers.path(name), layers.table(name).schema, layers.partition_by(name))
        for name in BATCH_LAYERS
    ], root)
    return counts


FORECAST_TABLES = ("predictions_overall", "predictions_category", "predictions_region")


def run_forecasts(
    spark: SparkSession,
    root: str,
    database: str,
    stream_table: str | None = None,
    horizon: int = forecast.HORIZON,
) -> dict[str, int]:
    """Forecasts from the published star schema, published as three tables.

    The streamed orders of stream_table join the overall series if that table exists;
    without it the batch alone counts. Returns the row count of every table.
    """
    use_database(spark, database)
    recover_switches(spark, root)
    fact, dates, products, regions = (
        scan(spark, f"{database}.{name}") for name in ("fact_orders", "dim_date", "dim_product", "dim_region")
    )
    overall = forecast.monthly_sales(fact, dates)
    streamed = scan_if_exists(spark, stream_table) if stream_table else None
    if streamed is not None:
        overall = forecast.merged_months(overall, forecast.monthly_stream(streamed))
    last = forecast.last_month(dates)
    by_category = forecast.monthly_sales_by(fact, dates, products, "product_key", "category")
    by_region = forecast.monthly_sales_by(fact, dates, regions, "region_key", "region")
    results = dict(zip(FORECAST_TABLES, (
        forecast.forecast_overall(overall, horizon),
        forecast.forecast_category(by_category, horizon=horizon, last=last),
        forecast.forecast_region(by_region, horizon=horizon, last=last),
    )))
    run = f"{root.rstrip('/')}/forecasts-{uuid.uuid4().hex}"
    for name, rows in results.items():
        write_files(rows.coalesce(1), f"{run}/{name}")
    switch_tables(spark, [Switch(f"{database}.{name}", f"{run}/{name}", rows.schema) for name, rows in results.items()], root)
    return {name: scan(spark, f"{database}.{name}").count() for name in results}
