"""Raw order lines made from the trade tables (lineitem, orders, customer, ...).

Every line of lineitem becomes one raw line, all columns as text under the raw
headings. Faults that cleaning must find are set by the line's own values: a
line keeps its place in the table, only the named column is spoiled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.packing import Packing
from orderloom.schema import ORDER_LINE_COLUMNS, ORDER_LINE_HEADINGS
from orderloom.sources.sizing import broadcast_by_itself, scan_bytes


def _fault(quantity: int) -> Column:
    return (F.col("l_quantity") == quantity) & F.col("l_faulty")


# What the raw lines take from lineitem, in the form in which a line is smallest when it is shuffled:
# amounts as whole cents and days instead of doubles and times, tests of a value instead of the value.
LINE_VALUES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_quantity": "l_quantity",
    "l_faulty": "l_tax < 0.035D",
    "l_returned": "l_returnflag = 'R'",
    "l_extendedprice": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "l_discount": "CAST(l_discount AS DECIMAL(4,2))",
    "l_shipdate": "CAST(l_shipdate AS DATE)",
}

# Bits that the small numbers of a line and of an order mostly need.
LINE_BITS = {"l_linenumber": 8, "l_quantity": 16, "l_faulty": 1, "l_returned": 1, "l_discount": 14, "l_shipdate": 20}
ORDER_BITS = {"o_orderdate": 20}


def _padded(value: Column) -> Column:
    return F.when(F.col("l_linenumber") == 1, F.concat(F.lit("  "), value, F.lit(" "))).otherwise(value)


def joined_trade(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem (see LINE_VALUES) with its order, customer, place and part.

    Left joins from lineitem keep every line. The customer side is put together
    before it meets the lines, so lineitem itself is shuffled for orders and
    parts only, or not at all where the other side is small enough for Spark to
    broadcast. Parts that are too large for it come first, as an order makes a line
    wider than a part does; small ones come last, as they are not shuffled with the line then.
    What is shuffled is packed (see Packing).
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    place = table("nation").join(table("region"), F.expr("n_regionkey = r_regionkey"), "left")
    customer = table("customer").join(place, F.expr("c_nationkey = n_nationkey"), "left")
    orders = table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    orders = orders.join(customer, F.expr("o_custkey = c_custkey"), "left")
    texts = ["o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name", "r_name"]
    orders = orders.select("o_orderkey", "c_custkey", *ORDER_BITS, *texts)
    part = table("part").select("p_partkey", "p_name", "p_type", "p_brand")
    lines = table("lineitem").select(*[F.expr(value).alias(name) for name, value in LINE_VALUES.items()])
    small = broadcast_by_itself(part)
    packings = {
        "line": Packing(lines, LINE_BITS, label="line"),
        "order": Packing(orders, ORDER_BITS, texts, label="order"),
        "part": Packing(part, {}, [] if small else ["p_name", "p_type", "p_brand"], label="part"),
    }
    lines, orders, part = (packings[k].packed(rows) for k, rows in (("line", lines), ("order", orders), ("part", part)))
    sides = [(orders, F.expr("l_orderkey = o_orderkey")), (part, F.expr("l_partkey = p_partkey"))]
    for side, same in sides if small else reversed(sides):
        lines = lines.join(side, same, "left")
    for packing in packings.values():
        lines = packing.unpacked(lines)
    return lines


def line_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the files that hold the lines, by far the largest table joined."""
    return scan_bytes(spark.read.parquet(f"{folder}/lineitem.parquet"))


def raw_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    sales, discount, order_date = F.col("l_extendedprice"), F.col("l_discount"), F.col("o_orderdate")
    profit = (sales * (F.lit("0.30").cast("decimal(3,2)") - 4 * discount)).cast("decimal(18,4)")
    values = {
        "row_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "order_id": F.when(~_fault(31), _padded(F.col("l_orderkey").cast("string"))),
        "order_date": F.when(_fault(17), F.date_format(order_date, "dd-MM-yyyy"))
        .otherwise(order_date.cast("string")),
        "ship_date": F.col("l_shipdate"),
        "ship_mode": _padded(F.col("o_orderpriority")),
        "customer_id": F.when(_fault(37), F.lit("   "))
        .when(~_fault(11), F.col("c_custkey").cast("string")),
        "customer_name": _padded(
            F.when(F.col("o_orderstatus") == "P", F.concat(F.col("c_name"), F.lit(" & Co")))
            .otherwise(F.col("c_name"))
        ),
        "segment": _padded(F.col("c_mktsegment")),
        "country": F.lit("United States"),
        "city": F.concat_ws("-", F.col("n_name"), F.pmod(F.col("c_custkey"), F.lit(4)).cast("string")),
        "state": F.col("n_name"),
        "postal_code": F.lpad(F.pmod(F.col("c_custkey"), F.lit(100)).cast("string"), 5, "0"),
        "region": F.col("r_name"),
        "product_id": F.when(~_fault(41), _padded(F.col("l_partkey").cast("string"))),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_name": F.when(F.col("l_returned"), F.concat(F.col("p_name"), F.lit(" II")))
        .otherwise(F.col("p_name")),
        "sales": F.when(_fault(29), F.lit("n/a"))
        .when(_fault(23), (-sales).cast("string"))
        .otherwise(sales.cast("string")),
        "quantity": F.col("l_quantity").cast("int"),
        "discount": F.when(_fault(43), F.lit("1.50")).otherwise(discount.cast("string")),
        "profit": profit,
    }
    return joined_trade(spark, folder).select(*[
        values[name].cast("string").alias(heading)
        for name, heading in zip(ORDER_LINE_COLUMNS, ORDER_LINE_HEADINGS)
    ])


# Types that numbers and dates of a source have whose lines do not come as text.
TYPED_SOURCE = {
    "row_id": "long", "order_date": "date", "ship_date": "timestamp", "postal_code": "long",
    "sales": "double", "quantity": "double", "discount": "double", "profit": "double",
}


def typed_order_lines(bronze: DataFrame) -> DataFrame:
    """The lines as a source with types of its own has them.

    By their own quantity, some carry what the types of silver cannot hold: sales with more
    decimals, half a piece, a profit or discount out of range, a time of day on the day of shipping.
    """
    rows = bronze.select(*[F.col(c).try_cast(TYPED_SOURCE.get(c, "string")).alias(c) for c in bronze.columns])
    pieces = F.col("quantity")
    return rows.withColumns({
        "sales": F.when(pieces == 13, F.col("sales") / 7).otherwise(F.col("sales")),
        "quantity": F.when(pieces == 19, pieces + 0.5).when(pieces == 21, F.lit(3e9)).otherwise(pieces),
        "profit": F.when(pieces == 7, F.lit(2e19)).otherwise(F.col("profit")),
        "discount": F.when(pieces == 5, F.lit(float("nan"))).otherwise(F.col("discount")),
        "ship_date": F.when(pieces == 3, F.col("ship_date") + F.expr("INTERVAL 9 HOURS")).otherwise(F.col("ship_date")),
    })


def csv_text(bronze: DataFrame) -> DataFrame:
    """The lines as records of a CSV file, in one text column.

    By their own quantity, some are cut off after the sales, some have a comma in the name
    of the product that no quotes protect, and some a line feed that quotes do.
    """
    pieces = F.col("quantity")
    name = F.when(pieces == "9", F.concat(F.col("product_name"), F.lit("\n(new)"))).otherwise(F.col("product_name"))

    def field(column: str) -> Column:
        value = F.coalesce(name if column == "product_name" else F.col(column), F.lit(""))
        quotes = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        written = F.when(value.rlike('[",\n]'), quotes).otherwise(value)
        return F.when(pieces == "7", F.concat(value, F.lit(", blue"))).otherwise(written) if column == "product_name" else written

    last = ORDER_LINE_COLUMNS.index("sales") + 1
    whole, cut = (F.concat_ws(",", *[field(c) for c in columns]) for columns in (ORDER_LINE_COLUMNS, ORDER_LINE_COLUMNS[:last]))
    return bronze.select(F.when(pieces == "3", cut).otherwise(whole).alias("value"))
