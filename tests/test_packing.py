from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import joins, keys
from orderloom.functions.joins import looked_up_together, slices_together
from orderloom.functions.keys import unique_per_key
from orderloom.functions.packing import SEPARATOR, Packing
from orderloom.operators import star
from orderloom.plans.layers import Layers
from tests.lines import GOOD, line, text_lines

SCHEMA = "id int, n int, day date, rate decimal(4,2), pieces double, flag boolean, a string, b string, money decimal(24,6)"
DAY = datetime.date(1997, 3, 4)
FITS = (200, DAY, Decimal("0.07"), 17.0, True, "x", "y z", Decimal("123.456789"))
ODD = [
    {0: None}, {0: -1}, {0: 256}, {0: 2**31 - 1}, {1: None}, {1: datetime.date(1969, 12, 31)}, {1: datetime.date(9999, 12, 31)},
    {2: None}, {2: Decimal("-0.01")}, {2: Decimal("99.99")}, {3: None}, {3: 17.5}, {3: -0.0}, {3: float("nan")},
    {3: float("inf")}, {3: 1e300}, {4: None}, {4: False}, {5: None}, {5: ""}, {5: f"x{SEPARATOR}"}, {6: None}, {6: ""},
    {5: "", 6: ""}, {5: SEPARATOR, 6: SEPARATOR}, {5: " ü ", 6: "\n"}, {7: None}, {7: Decimal("-0.000001")},
    {7: Decimal("999999999999999999.999999")}, {0: 0, 1: datetime.date(1970, 1, 1), 2: Decimal("0.00"), 7: Decimal("0")},
    dict.fromkeys(range(8)),
]


def packing_of(rows):
    bits = {"n": 8, "day": 20, "rate": 14, "pieces": 10, "flag": 1}
    return Packing(rows, bits, ["a", "b"], ["money"])


def test_every_row_comes_back_as_it_was(spark):
    rows = [(0, *FITS)] + [(i, *[odd.get(k, v) for k, v in enumerate(FITS)]) for i, odd in enumerate(ODD, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    packing = packing_of(df)
    there = packing.packed(df).localCheckpoint()
    back = packing.unpacked(there).select(df.columns)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert [repr(r) for r in back.orderBy("id").collect()] == [repr(r) for r in df.orderBy("id").collect()]
    kept = {r.id for r in there.where("_packed_rest IS NULL").collect()}
    assert {0, 30} <= kept and not kept & {1, 2, 3, 6, 13, 14, 16, 21, 25, 29, 31}


def test_a_row_without_a_match_stays_null(spark):
    right = spark.createDataFrame([(1, *FITS)], SCHEMA)
    packing = packing_of(right)
    met = spark.range(1, 3).select(F.col("id").alias("k")).join(packing.packed(right), F.col("k") == F.col("id"), "left")
    got = {r.k: r for r in packing.unpacked(met).collect()}
    assert (got[1].n, got[1].b, got[1].money) == (200, "y z", Decimal("123.456789"))
    assert [got[2][c] for c in right.columns] == [None] * 9


def test_too_many_bits_are_refused(spark):
    rows = spark.createDataFrame([], "a long, b long")
    with pytest.raises(ValueError, match="64 bits"):
        Packing(rows, {"a": 32, "b": 32})


@pytest.fixture()
def large(spark, tmp_path, monkeypatch):
    """Lines of which a third have one customer and a sixth none, a hot product, keys without a member."""
    customer = F.expr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 6 = 1 THEN NULL ELSE id % 911 END").cast("long")
    product = F.expr("CASE WHEN id % 4 = 0 THEN 8 ELSE id % 877 END").cast("long")
    spark.range(0, 24_000, 1, 6).select(
        F.col("id").cast("string").alias("order_id"), F.expr("if(id % 5 = 0, NULL, 'Air')").alias("ship_mode"),
        F.expr("cast(if(id % 7 = 0, NULL, 20160101 + id % 20) as int)").alias("date_key"), customer.alias("customer_key"),
        product.alias("product_key"), F.expr("id % 9").alias("region_key"), F.expr("cast(id * 1.000001 as decimal(24,6))").alias("sales"),
        F.expr("cast(id % 50 as int)").alias("quantity"), F.expr("cast(id % 3 as decimal(12,6))").alias("discount"),
        F.expr("cast(-id as decimal(24,6))").alias("profit"), F.expr("cast(2016 as int)").alias("order_year"),
    ).write.parquet(str(tmp_path / "fact"))
    dims = {
        "dates": spark.range(15).selectExpr("date'2016-01-01' + cast(id as int) AS order_date", "cast(20160101 + id as int) AS date_key", "'May' AS month_name"),
        "customers": spark.range(900).selectExpr("cast(id as string) AS customer_id", "if(id % 4 = 0, NULL, concat('n', id)) AS customer_name", "id AS customer_key"),
        "products": spark.range(870).selectExpr("concat('p', id) AS product_id", "'' AS category", "if(id = 9, NULL, id) AS product_key"),
        "regions": spark.range(8).selectExpr("'R' AS region", "id AS region_key"),
    }
    for name, rows in dims.items():
        rows.repartition(2).write.parquet(str(tmp_path / name))
    monkeypatch.setattr(joins, "SLICE_BYTES", 4_000)
    small = lambda t: not {"customer_key", "product_key"} & set(t.columns)
    monkeypatch.setattr(star, "fits_broadcast", small)
    monkeypatch.setattr(joins, "fits_broadcast", small)
    return [spark.read.parquet(str(tmp_path / n)) for n in ("fact", *dims)]


def test_large_dimensions_are_looked_up_in_one_shuffle_of_the_lines(large):
    fact, *dims = large
    found = star.fact_enriched(fact, *dims)
    expected = fact
    for dimension, key in zip(dims, ("date_key", "customer_key", "product_key", "region_key")):
        expected = expected.join(dimension, key, "left")
    expected = expected.select(found.columns)
    assert found.count() == 24_000
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Exchange shufflepartitionid") == 3


def test_hot_keys_do_not_fill_a_cell(spark, large):
    fact, _, customers, products, _ = large
    sides = [(customers, "customer_key"), (products, "product_key")]
    slices = slices_together(fact, sides, 4)
    assert min(slices) > 1
    met = looked_up_together(fact, sides, slices, star.fact_packing(fact, [key for _, key in sides]))
    assert met.columns == fact.columns + ["customer_id", "customer_name", "product_id", "category"]
    tasks = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    cells = slices[0] * slices[1]
    assert sum(tasks) == 24_000 and max(tasks) < 2 * 24_000 / cells


def test_members_that_come_twice_and_null_members(spark, large):
    fact, _, customers, products, _ = large
    twice = customers.unionByName(customers.where("customer_key IN (5, 7)"))
    sides = [(twice, "customer_key"), (products, "product_key")]
    met = looked_up_together(fact, sides, [3, 2], star.fact_packing(fact, [key for _, key in sides]))
    assert met.count() == fact.join(twice, "customer_key", "left").count()
    assert met.where("product_key = 9 AND product_id IS NOT NULL").count() == 0


def test_when_dimensions_are_not_looked_up_together(spark, large, monkeypatch):
    fact, _, customers, products, _ = large
    sides = [(customers, "customer_key"), (products, "product_key")]
    assert slices_together(fact, sides, 4) and not slices_together(fact, sides[:1], 4)
    cells = slices_together(fact, sides, 160)
    assert cells[0] * cells[1] >= 160 / joins.PARTITIONS_PER_CELL
    assert slices_together(fact.withColumn("customer_key", F.col("customer_key").cast("int")), sides, 4) is None
    assert slices_together(customers.join(products, F.col("customer_key") == F.col("product_key")).limit(1), sides, 10**6) is None
    monkeypatch.setattr(joins, "SLICE_BYTES", 1 << 20)
    assert slices_together(fact, sides, 4) is None


def test_keys_that_share_a_digest_are_told_apart(spark, monkeypatch):
    rows = [("a", "x", 2), ("a", "x", 1), ("a", "y", 3), (None, "x", 5), (None, "x", 4), ("b", "x", 6)]
    df = spark.createDataFrame(rows, "k string, l string, row_id long")
    expected = [("a", "x", 1), ("a", "y", 3), ("b", "x", 6), (None, "x", 4)]
    for digest in (F.xxhash64, lambda *keys: F.lit(1).cast("long")):
        monkeypatch.setattr("orderloom.functions.keys.F.xxhash64", digest)
        got = unique_per_key(df, ["k", "l"], {"row_id": "asc"}).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_lines_are_counted_by_a_digest_alone(spark, monkeypatch):
    written = []
    before = keys._kept
    monkeypatch.setattr(keys, "_kept", lambda rows, label, size: written.append((label, rows)) or before(rows, label, size))
    unique_per_key(text_lines(spark, GOOD, line(row_id="2"), line(order_id="B")), ["order_id", "product_id"], {"row_id": "asc"})
    (label, first), _ = written
    plan = first._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Aggregate":
        plan = plan.children().head()
    assert label == "repeated-digests" and plan.children().head().output().size() == 1


def test_files_of_line_layers_are_small(spark, tmp_path):
    layers = Layers(spark, lambda: text_lines(spark, GOOD), str(tmp_path / "layers"))
    layers._recipes["bronze"] = lambda: text_lines(spark, GOOD, line(row_id="2", order_id="B"))
    assert layers.row_count("fact_orders") == 2
    for name in ("bronze", "silver", "fact_orders"):
        files = layers.table(name).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert all(f.endswith(".snappy.parquet") for f in layers.table("dim_product").inputFiles())
