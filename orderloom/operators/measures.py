"""Business measures over the star schema.

Charts by an attribute of a dimension never shuffle order lines. A dimension of
checked small size is broadcast and the fact grouped by the attribute at once.
Beyond that size the fact is first added up per surrogate key, which map tasks do
before anything moves, and only those sums are joined: a key with a third of all
rows costs one line per task either way. By month as well, hardly two lines of a key
add up: there the measures of the lines are moved, once and in as many parts as they need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.amounts import percent, ratio, total
from orderloom.functions.dates import ist_label
from orderloom.functions.joins import looked_up
from orderloom.sources.sizing import fits_broadcast


# --- key figures -----------------------------------------------------------

def kpi_summary(fact: DataFrame) -> DataFrame:
    """Sales, profit, distinct orders, margin, order value, quantity, discount."""
    sums = fact.agg(
        F.coalesce(total("sales"), F.lit(0.0)).alias("total_sales"),
        F.coalesce(total("profit"), F.lit(0.0)).alias("total_profit"),
        F.countDistinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        total("discount").alias("_discount"),
        F.count("discount").alias("_discounts"),
    )
    return sums.select(
        "total_sales",
        "total_profit",
        "total_orders",
        percent("total_profit", "total_sales").alias("profit_margin_pct"),
        ratio("total_sales", "total_orders", 4).alias("avg_order_value"),
        "total_quantity",
        percent("_discount", "_discounts").alias("avg_discount_pct"),
    )


def kpi_profit(fact: DataFrame) -> DataFrame:
    """Profit, the loss in it, and rows with a profit or a loss."""
    loss = F.when(F.col("profit") < 0, F.col("profit"))
    return fact.agg(
        F.coalesce(total("profit"), F.lit(0.0)).alias("total_profit"),
        F.coalesce(total(loss), F.lit(0.0)).alias("total_loss"),
        F.count_if(F.col("profit") > 0).alias("profitable_orders"),
        F.count_if(F.col("profit") < 0).alias("loss_orders"),
    )


def kpi_customer(fact: DataFrame) -> DataFrame:
    """Customers, sales per customer, and customers with more than one order.

    A customer has more than one order when the smallest and the largest 64-bit
    digest of its order ids differ, so no order is shuffled to count it, and numbers
    (unlike texts) are aggregated by hash, without a sort.
    """
    order = F.when(F.col("order_id").isNotNull(), F.xxhash64("order_id"))
    per_customer = fact.groupBy("customer_key").agg(
        F.sum("sales").alias("sales"),
        (F.min(order) < F.max(order)).alias("repeats"),
    )
    known = F.col("customer_key").isNotNull()
    sums = per_customer.agg(
        F.count("customer_key").alias("total_customers"),
        F.count_if(known & F.col("repeats")).alias("repeat_customers"),
        F.coalesce(total("sales"), F.lit(0.0)).alias("_sales"),
    )
    return sums.select(
        "total_customers",
        "repeat_customers",
        ratio("_sales", "total_customers", 4).alias("avg_sales_per_customer"),
    )


def repeat_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with more than one distinct order, and how many they have."""
    counts = (
        fact.groupBy("customer_key")
        .agg(F.countDistinct("order_id").alias("distinct_orders"))
        .where("distinct_orders > 1")
    )
    return counts.join(customers, "customer_key").select(
        "customer_id", "customer_name", "distinct_orders"
    )


def kpi_product(products: DataFrame) -> DataFrame:
    return products.agg(F.countDistinct("product_id").alias("total_products"))


# --- charts ----------------------------------------------------------------

def per_member(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    sums: Mapping[str, str | Column],
    own: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Exact sums of the fact by attributes of one dimension and its own columns.

    partitions is for own columns that leave a key few lines to add up, such as the month: a
    dimension too large to broadcast is then looked up line by line, hot keys spread, in so many parts.
    """
    members = dimension.select(key, *attributes)
    added = [F.sum(c).alias(name) for name, c in sums.items()]
    if fits_broadcast(members):
        return fact.join(F.broadcast(members), key, "left").groupBy(*attributes, *own).agg(*added)
    if partitions is not None:
        lines = fact.select(key, *own, *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in sums.items()])
        found = looked_up(lines, members, [key], partitions=partitions)
        return found.groupBy(*attributes, *own).agg(*[F.sum(name).alias(name) for name in sums])
    per_key = fact.groupBy(key, *own).agg(*added).join(members, key, "left")
    return per_key.groupBy(*attributes, *own).agg(*[F.sum(name).alias(name) for name in sums])


def amounts_by(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    measure: str,
    name: str,
) -> DataFrame:
    """One money measure by attributes of one dimension."""
    return per_member(fact, dimension, key, attributes, {name: measure}).withColumn(
        name, F.col(name).cast("double")
    )


def quantity_by(fact: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    return per_member(fact, dimension, key, [attribute], {"total_quantity": "quantity"})


def _exact(column: str, digits: int) -> Column:
    """Sum of amounts shown as doubles, in any order the same: they are decimals of so many digits."""
    return F.sum(F.col(column).cast(f"decimal(30,{digits})")).cast("double")


def with_share(amounts: DataFrame, measure: str, name: str = "share_pct") -> DataFrame:
    """Each group's percentage of the sum over all groups.

    The sum is a scalar subquery over the grouped rows: no window that pulls
    all groups into one task.
    """
    whole = amounts.agg(_exact(measure, 6)).scalar()
    return amounts.withColumn(name, percent(measure, whole))


def amounts_by_ship_mode(fact: DataFrame) -> DataFrame:
    """Sales by ship mode, which the fact carries itself, with shares."""
    return with_share(fact.groupBy("ship_mode").agg(total("sales").alias("total_sales")), "total_sales")


def with_growth(yearly: DataFrame, measure: str = "total_sales") -> DataFrame:
    """Change against the year before, in percent; null where that year has no sales.

    Each year hands its amount on to the next one, so the yearly sums are
    computed once: no self-join, no window over all years.
    """
    amount, nothing = F.col(measure), F.lit(None).cast("double")
    own = F.struct("year", amount.alias(measure), nothing.alias("before"), F.lit(True).alias("own"))
    handed_on = F.struct(
        (F.col("year") + 1).alias("year"), nothing.alias(measure), amount.alias("before"),
        F.lit(False).alias("own"),
    )
    change = F.try_divide((amount - F.col("before")) * 100, F.col("before"))
    return (
        yearly.select(F.inline(F.array(own, handed_on)))
        .groupBy("year")
        .agg(
            F.max(measure).alias(measure),
            F.max("before").alias("before"),
            F.bool_or("own").alias("own"),
        )
        .where("own")
        .select("year", measure, F.round(change, 4).alias("growth_pct"))
    )


def orders_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Distinct orders per year."""
    orders = fact.select("date_key", "order_id").join(dates.select("date_key", "year"), "date_key", "left")
    return orders.groupBy("year").agg(F.countDistinct("order_id").alias("total_orders"))


def top(amounts: DataFrame, measure: str, tie_break: str, n: int) -> DataFrame:
    """The n largest groups; Spark keeps n rows per task, never a full sort."""
    return amounts.orderBy(F.col(measure).desc_nulls_last(), F.col(tie_break)).limit(n)


def top_members(
    fact: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str], n: int
) -> DataFrame:
    """The n members with the highest sales, ties broken by their key.

    Names are looked up for the n found members only, so no member list is
    shuffled however long it is. A member its dimension does not hold stays, without
    a name. The few rows are put in order again after the look-up.
    """
    sales = fact.where(F.col(key).isNotNull()).groupBy(key).agg(total("sales").alias("total_sales"))
    found = top(sales, "total_sales", key, n).join(dimension.select(key, *attributes), key, "left")
    return found.orderBy(F.col("total_sales").desc_nulls_last(), key).select(*attributes, "total_sales")


def bottom(amounts: DataFrame, measure: str, tie_break: str, n: int) -> DataFrame:
    """The n smallest groups; one without an amount comes last."""
    return amounts.orderBy(F.col(measure).asc_nulls_last(), F.col(tie_break)).limit(n)


# --- live totals -----------------------------------------------------------

def category_region_totals(lines: DataFrame) -> DataFrame:
    """Live totals by category and region; total_orders counts lines.

    Works on a batch and, in complete mode, on a stream.
    """
    return lines.groupBy("category", "region").agg(
        total("sales", 2).alias("total_sales"),
        F.count("order_id").alias("total_orders"),
        total("profit", 2).alias("total_profit"),
        F.round(F.avg("discount"), 4).cast("double").alias("avg_discount"),
    )


def distinct_orders_by_category_region(lines: DataFrame) -> DataFrame:
    """Distinct orders next to the line count of the live totals."""
    return lines.groupBy("category", "region").agg(
        F.countDistinct("order_id").alias("distinct_orders")
    )


def live_totals(totals: DataFrame) -> DataFrame:
    """Sum over all rows of the live totals (no group)."""
    return totals.groupBy().agg(
        _exact("total_sales", 2).alias("total_sales"),
        F.sum("total_orders").alias("total_orders"),
        _exact("total_profit", 2).alias("total_profit"),
    )


def live_by(totals: DataFrame, *columns: str) -> DataFrame:
    return totals.groupBy(*columns).agg(_exact("total_sales", 2).alias("total_sales"))


def last_updated_ist(totals: DataFrame) -> DataFrame:
    """When the live totals were last written, in India time."""
    return totals.agg(F.max("last_updated").alias("at")).select(
        ist_label(F.col("at"), zoned=True).alias("last_updated_ist")
    )
