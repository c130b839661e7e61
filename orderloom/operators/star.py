"""Gold: date, customer, product and region dimensions, and the order fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.joins import looked_up, looked_up_together, slices_together
from orderloom.functions.keys import date_key, first_per_key, surrogate_key
from orderloom.functions.packing import Packing, can_be_number, short_decimal
from orderloom.sources.sizing import PARTITIONS_SETTING, fits_broadcast, line_scan_bytes, partitions_for

CUSTOMER_ATTRIBUTES = ("customer_name", "segment")
PRODUCT_ATTRIBUTES = ("product_name", "category", "sub_category")
REGION_KEY = ("region", "state", "city")

# Natural key and surrogate key of the dimensions whose keys are digests.
MEMBER_KEYS = {
    "dim_customer": (("customer_id",), "customer_key"),
    "dim_product": (("product_id",), "product_key"),
    "dim_region": (REGION_KEY, "region_key"),
}

# The columns of the fact.
FACT_COLUMNS = (
    "order_id", "ship_mode", "date_key", "customer_key", "product_key",
    "region_key", "sales", "quantity", "discount", "profit",
)

# Bits that the fact's small numbers mostly need: dates up to the year 3354, 16,383 pieces, discounts up to 16.
FACT_BITS = {"date_key": 25, "quantity": 14, "discount": 24}

# Bits of a row_id that, with a day, mostly make one long.
ROW_BITS = 40


def dim_date(lines: DataFrame) -> DataFrame:
    """One row per order date, in order; lines without a date have none."""
    day = F.col("order_date")
    return lines.select("order_date").where(day.isNotNull()).distinct().select(
        "order_date",
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month_name"),
    ).orderBy("order_date")


def newest(lines: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The attributes of every key as on its latest order, lowest row_id first.

    An id that came with two names is one member, so a fact line can never
    match twice. A hash aggregate first leaves one row per id and attributes, so
    lines are not sorted; only those few rows are put in order. Where hardly two lines of a task
    agree, that is nearly all of them: id and attributes are one text then, and recency mostly a long.
    """
    texts = {f.name for f in lines.schema if isinstance(f.dataType, T.StringType)}
    packing = Packing(lines, {}, [c for c in (key, *attributes) if c in texts])
    day, row = F.coalesce(F.unix_date("order_date").cast("long"), F.lit(-(1 << 32))), F.col("row_id").cast("long")
    near = day.between(-(1 << 22), (1 << 22) - 1) & row.between(0, (1 << ROW_BITS) - 1)
    rows = packing.packed(lines.where(F.col(key).isNotNull()).select(
        key,
        *attributes,
        F.when(near, F.shiftleft(day, ROW_BITS) - row).alias("_near"),
        F.when(~F.coalesce(near, F.lit(False)), _recency(day, F.col("row_id"))).alias("_far"),
    ))
    groups = [c for c in rows.columns if c not in ("_near", "_far")]
    rows = packing.unpacked(rows.groupBy(*groups).agg(F.max("_near").alias("_near"), F.max("_far").alias("_far")))
    day = F.shiftright(F.col("_near") + ((1 << ROW_BITS) - 1), ROW_BITS)
    rows = rows.withColumn("_recency", F.greatest(_recency(day, F.shiftleft(day, ROW_BITS) - F.col("_near")), "_far"))
    return first_per_key(rows.select(key, *attributes, "_recency"), [key], {"_recency": "desc"}).select(key, *attributes)


def _recency(day: Column, row: Column) -> Column:
    """Order day and row_id as one number, larger for the line that counts: a later day, then a lower row_id.

    A number can be aggregated by hash, a struct cannot. A missing day comes as one before every
    day there can be; a missing row_id counts as beyond all others. With a null day there is no number.
    """
    row = F.coalesce(row.cast("decimal(20,0)"), F.lit(Decimal(10**19)))
    return (day.cast("decimal(11,0)") * F.lit(Decimal(10**20)) - row).cast("decimal(38,0)")


def dim_customer(lines: DataFrame) -> DataFrame:
    return newest(lines, "customer_id", CUSTOMER_ATTRIBUTES).withColumn(
        "customer_key", surrogate_key("customer_id")
    )


def dim_product(lines: DataFrame) -> DataFrame:
    return newest(lines, "product_id", PRODUCT_ATTRIBUTES).withColumn(
        "product_key", surrogate_key("product_id")
    )


def dim_region(lines: DataFrame) -> DataFrame:
    return lines.select(*REGION_KEY).distinct().withColumn(
        "region_key", surrogate_key(*REGION_KEY)
    )


def fact_orders(lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The fact straight from the lines: every key is computed, nothing is joined.

    Same rows as fact_orders_joined over the dimensions of the same lines,
    without moving a single one of them. extra names columns of the lines that come along.
    """
    return lines.select(
        "order_id",
        "ship_mode",
        date_key("order_date").alias("date_key"),
        F.when(F.col("customer_id").isNotNull(), surrogate_key("customer_id")).alias("customer_key"),
        F.when(F.col("product_id").isNotNull(), surrogate_key("product_id")).alias("product_key"),
        surrogate_key(*REGION_KEY).alias("region_key"),
        "sales",
        "quantity",
        "discount",
        "profit",
        *extra,
    )


def other_keys(dimension: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Members whose key is not the digest of their natural key: it came from elsewhere, or another has it."""
    return dimension.where(F.col(key) != surrogate_key(*natural)).select(*natural, F.col(key).alias("_other"))


def fact_orders_with(lines: DataFrame, others: Mapping[str, DataFrame]) -> DataFrame:
    """fact_orders, and the keys of the members that others lists per dimension (see other_keys).

    All other keys are computed. What is looked up goes by natural key, as a digest may be shared.
    """
    for name, members in others.items():
        natural, key = MEMBER_KEYS[name]
        lines = looked_up(lines, members.withColumnRenamed("_other", f"_{key}"), natural, null_safe=True)
    found = {MEMBER_KEYS[name][1] for name in others}
    fact = fact_orders(lines, extra=[f"_{key}" for key in found])
    return fact.withColumns({key: F.coalesce(f"_{key}", key) for key in found}).select(*FACT_COLUMNS)


def with_known_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """The fact with the keys a customer dimension really carries.

    A dimension refreshed in place (Type 1) keeps the keys its customers had, which may
    come from elsewhere. Only those that differ from the computed ones are looked up; if
    there are none, nothing is joined but an empty table.
    """
    computed = surrogate_key("customer_id")
    other = customers.where(F.col("customer_key") != computed).select(
        computed.alias("customer_key"), F.col("customer_key").alias("_known")
    )
    return fact.join(other, "customer_key", "left").withColumn(
        "customer_key", F.coalesce("_known", "customer_key")
    ).select(*fact.columns)


def unresolved_keys(fact: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension, how many fact lines carry a key that it does not hold; all must be 0.

    Keys are made distinct before they are compared, map-side, so no line is moved.
    """
    counts = []
    for name, (dimension, key) in dimensions.items():
        used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("lines"))
        lost = used.join(dimension.select(key), key, "left_anti")
        counts.append(lost.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("unresolved_lines")).select(
            F.lit(name).alias("dimension"), "unresolved_lines"
        ))
    return reduce(DataFrame.unionByName, counts)


def with_order_year(fact: DataFrame) -> DataFrame:
    """The fact with the year of its date key, to lay files out by."""
    return fact.withColumn("order_year", F.floor(F.col("date_key") / 10000).cast("int"))


def fact_orders_joined(
    lines: DataFrame,
    dates: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: DataFrame,
) -> DataFrame:
    """The fact by looking keys up in given dimensions, whatever keys they carry.

    For dimensions whose keys come from elsewhere. A line with no match keeps
    its place with a null key. Region parts may be null, so they are compared
    null-safely. Members that most lines have do not hold it up (see looked_up).
    """
    fact = looked_up(lines, dates.select("order_date", "date_key"), ["order_date"])
    fact = looked_up(fact, customers.select("customer_id", "customer_key"), ["customer_id"])
    fact = looked_up(fact, products.select("product_id", "product_key"), ["product_id"])
    fact = looked_up(fact, regions.select(*REGION_KEY, "region_key"), REGION_KEY, null_safe=True)
    return fact.select(*FACT_COLUMNS)


def fact_enriched(
    fact: DataFrame,
    dates: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: DataFrame,
) -> DataFrame:
    """The fact with the columns of all four dimensions, one row per fact row, hot keys spread.

    Dimensions that are too large to broadcast come first, before the other columns make the lines
    wider. Several of them are looked up together, in one shuffle of the lines, unless
    they are so large that one after the other moves less; the lines are then shuffled for each,
    in as many parts as their size asks for.
    """
    dimensions = ((dates, "date_key"), (customers, "customer_key"), (products, "product_key"), (regions, "region_key"))
    columns = fact.columns + [c for dimension, key in dimensions for c in dimension.columns if c != key]
    partitions = partitions_for(line_scan_bytes(fact), int(fact.sparkSession.conf.get(PARTITIONS_SETTING)))
    large = [d for d in dimensions if not fits_broadcast(d[0])]
    slices = slices_together(fact, large, partitions)
    lines = fact
    if slices:
        lines = looked_up_together(fact, large, slices, fact_packing(fact, [key for _, key in large]))
        large = []
    for dimension, key in large + [d for d in dimensions if fits_broadcast(d[0])]:
        lines = looked_up(lines, dimension, [key], partitions=partitions, among=fact)
    return lines.select(*columns)


def fact_packing(fact: DataFrame, keys: Sequence[str]) -> Packing:
    """How the fact's columns other than the keys looked up are moved."""
    kinds = {f.name: f.dataType for f in fact.schema if f.name not in keys}
    return Packing(
        fact,
        {c: bits for c, bits in FACT_BITS.items() if c in kinds and can_be_number(kinds[c])},
        [c for c, kind in kinds.items() if isinstance(kind, T.StringType)],
        [c for c, kind in kinds.items() if isinstance(kind, T.DecimalType) and not short_decimal(kind)],
    )


def refreshed_customers(existing: DataFrame, lines: DataFrame) -> DataFrame:
    """Type 1 refresh: newest name and segment overwrite, keys stay.

    New customers are added, customers without new lines stay as they were. The lines count as
    newer than what is known, whatever their dates: the dimension holds none to compare with.
    Lines that arrive late are to be refreshed together with the later ones, or not at all.
    """
    latest = newest(lines, "customer_id", CUSTOMER_ATTRIBUTES)
    known, new = existing.alias("known"), latest.alias("new")
    is_new = F.col("new.customer_id").isNotNull()
    joined = known.join(new, F.col("known.customer_id") == F.col("new.customer_id"), "full_outer")
    customer_id = F.coalesce("known.customer_id", "new.customer_id")
    return joined.select(
        customer_id.alias("customer_id"),
        *[
            F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"known.{c}")).alias(c)
            for c in CUSTOMER_ATTRIBUTES
        ],
        F.coalesce("known.customer_key", surrogate_key(customer_id)).alias("customer_key"),
    )
