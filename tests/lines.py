"""Small hand-made order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.schema import ORDER_LINE_COLUMNS

GOOD = {
    "row_id": "1", "order_id": "N-1001", "order_date": "2016-11-17", "ship_date": "2016-11-19",
    "ship_mode": "Standard", "customer_id": "K-7", "customer_name": "Orla Brandt", "segment": "Consumer",
    "country": "Ireland", "city": "Galway", "state": "Connacht", "postal_code": "40917", "region": "Coast",
    "product_id": "CHA-77", "category": "Seating", "sub_category": "Stools", "product_name": "Oak stool",
    "sales": "118.4", "quantity": "2", "discount": "0.05", "profit": "12.3456",
}

# One line per fault that a cleaning run has to catch.
FAULTY = [
    {"row_id": "7001", "order_id": "N-2001", "ship_mode": " Standard", "customer_id": None},
    {"row_id": "7002", "product_name": "Oak stool, listed again"},
    {"row_id": "7003", "order_id": "N-2003", "order_date": "17.11.2016", "ship_date": "19.11.2016",
     "customer_name": " Ben Fynn   ", "segment": "   Trade", "city": "  Sligo ", "product_id": "CHA-78",
     "sales": "9.75"},
    {"row_id": "7004", "order_id": "N-2004", "product_id": "LMP-04", "sales": "-20.5", "profit": "-31.25"},
    {"row_id": "7005", "order_id": None, "product_id": "LMP-05", "sales": "7.125"},
]


def line(**changes) -> dict:
    return {**GOOD, **changes}


def text_lines(spark: SparkSession, *rows: dict) -> DataFrame:
    """All-text lines, as they come from a file."""
    schema = ", ".join(f"{c} STRING" for c in ORDER_LINE_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in ORDER_LINE_COLUMNS) for r in rows], schema)


def faulty_lines(spark: SparkSession) -> DataFrame:
    return text_lines(spark, GOOD, *[line(**f) for f in FAULTY])
