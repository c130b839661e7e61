"""Column names, types and cleaning rules shared by the batch and stream paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw column headings in file order and the names they become.
ORDER_LINE_HEADINGS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode",
    "Customer ID", "Customer Name", "Segment", "Country", "City",
    "State", "Postal Code", "Region", "Product ID", "Category",
    "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit",
)

# Money is exact: double sums depend on the order in which partitions merge. 18 digits
# before the point and six behind hold every amount that a double holds to the cent; what
# does not fit is reported (cleaning.flaws), not rounded in silence.
MONEY = T.DecimalType(24, 6)
RATE = T.DecimalType(12, 6)

ORDER_LINE_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("ship_date", T.DateType()),
    T.StructField("ship_mode", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", RATE),
    T.StructField("profit", MONEY),
])

# The text of a record that a file's reader could not take apart; null for a whole line.
BROKEN_RECORD = "broken_record"

ORDER_LINE_COLUMNS = tuple(ORDER_LINE_SCHEMA.fieldNames())

# What a stream cleaning run appends: the order line, when and by which feed.
CLEAN_STREAM_SCHEMA = T.StructType(
    ORDER_LINE_SCHEMA.fields
    + [
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("data_source", T.StringType()),
    ]
)

# The columns of the live totals.
LIVE_TOTALS_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("total_sales", T.DoubleType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_profit", T.DoubleType()),
    T.StructField("avg_discount", T.DoubleType()),
    T.StructField("last_updated", T.TimestampType()),
])

DATE_FORMAT = "yyyy-MM-dd"

# Month 1 of the trend's time axis is January of this year.
BASE_YEAR = 2015

DEDUP_KEY = ("order_id", "product_id")

# postal_code is a number in a batch file and text in the stream.
BATCH_TEXT_COLUMNS = tuple(
    f.name for f in ORDER_LINE_SCHEMA if isinstance(f.dataType, T.StringType) and f.name != "postal_code"
)
STREAM_TEXT_COLUMNS = BATCH_TEXT_COLUMNS + ("postal_code",)


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate; a row stays only where it is true (null rejects)."""

    name: str
    keep: str


@dataclass(frozen=True)
class Profile:
    """What one cleaning path trims, tests (in this order) and deduplicates on."""

    name: str
    text_columns: tuple[str, ...]
    rules: tuple[Rule, ...]
    dedup_key: tuple[str, ...] = ()


_NULL_ORDER = Rule("null_order", "order_id IS NOT NULL")
_NULL_CUSTOMER = Rule("null_customer", "customer_id IS NOT NULL")
_NULL_PRODUCT = Rule("null_product", "product_id IS NOT NULL")
_NULL_SALES = Rule("null_sales", "sales IS NOT NULL")
_BAD_DATE = Rule("bad_date", "order_date IS NOT NULL")

# First version of the batch rules: key columns present, nothing else.
BATCH_V1 = Profile(
    "v1",
    BATCH_TEXT_COLUMNS,
    (_NULL_ORDER, _NULL_CUSTOMER, _NULL_PRODUCT, _NULL_SALES),
    DEDUP_KEY,
)

# Second version, the default: also no blank keys, bad dates or negative sales.
BATCH_V2 = Profile(
    "v2",
    BATCH_TEXT_COLUMNS,
    (
        _NULL_ORDER,
        _NULL_CUSTOMER,
        _NULL_PRODUCT,
        Rule("blank_key", "order_id <> '' AND customer_id <> '' AND product_id <> ''"),
        _NULL_SALES,
        _BAD_DATE,
        Rule("negative_sales", "sales >= 0"),
    ),
    DEDUP_KEY,
)

# Stream rules: row-level only. Removing duplicates would keep every key as
# state for ever, so the stream does not.
STREAM = Profile(
    "stream",
    STREAM_TEXT_COLUMNS,
    (
        _NULL_ORDER,
        _NULL_CUSTOMER,
        Rule("blank_key", "order_id <> '' AND customer_id <> ''"),
        _NULL_SALES,
        _BAD_DATE,
        Rule("sales_not_positive", "sales > 0"),
        Rule("quantity_not_positive", "quantity > 0"),
        Rule("discount_out_of_range", "discount BETWEEN 0 AND 1"),
    ),
)
