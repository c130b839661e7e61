from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions.keys import first_per_key, unique_per_key
from orderloom.operators import quality
from orderloom.operators.cleaning import clean, deduplicated, flaw_names, flaws, prepared, typed, valid
from orderloom.schema import BATCH_V1, BATCH_V2, ORDER_LINE_COLUMNS, ORDER_LINE_SCHEMA, STREAM
from orderloom.sources import sizing
from tests.lines import GOOD, faulty_lines, line, text_lines


def ids(df):
    return sorted(r.row_id for r in df.collect())


def test_typed_matches_schema_and_values(spark):
    df = typed(text_lines(spark, GOOD))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ORDER_LINE_SCHEMA]
    row = df.first()
    assert row.order_date == dt.date(2016, 11, 17)
    assert row.sales == Decimal("118.4000") and row.quantity == 2 and row.postal_code == "40917"


def test_typed_takes_typed_input(spark):
    once = typed(text_lines(spark, GOOD))
    assert typed(once).collect() == once.collect()
    as_double = once.withColumns({"sales": once.sales.cast("double"), "postal_code": once.postal_code.cast("long")})
    row = typed(as_double).first()
    assert row.sales == Decimal("118.4000") and row.postal_code == "40917"


def test_unreadable_values_become_null(spark):
    row = typed(text_lines(spark, line(sales="abc", order_date="08-11-2016", quantity="x"))).first()
    assert row.sales is None and row.order_date is None and row.quantity is None


def test_first_rules_keep_bad_date_and_negative_sale(spark):
    assert ids(clean(faulty_lines(spark), BATCH_V1)) == [1, 7003, 7004]


def test_second_rules_keep_only_the_good_line(spark):
    rows = clean(faulty_lines(spark), BATCH_V2).collect()
    assert [r.row_id for r in rows] == [1]
    assert rows[0].product_name == "Oak stool"


def test_text_is_trimmed(spark):
    rows = {r.row_id: r for r in clean(faulty_lines(spark), BATCH_V1).collect()}
    spacey = rows[7003]
    assert (spacey.customer_name, spacey.segment, spacey.city) == ("Ben Fynn", "Trade", "Sligo")


def test_checks_passed_before_and_after(spark):
    first = {r.rule: r.passed for r in quality.rule_report(clean(faulty_lines(spark), BATCH_V1)).collect()}
    checks = ["null_customer", "duplicate_key", "bad_date", "negative_sales", "null_order"]
    assert [c for c in checks if first[c]] == ["null_customer", "duplicate_key", "null_order"]
    second = quality.rule_report(clean(faulty_lines(spark), BATCH_V2))
    assert second.where("NOT passed").count() == 0
    assert quality.validation_summary(second).first() == (8, 8)


def test_null_copy_does_not_take_the_valid_line_down(spark):
    df = text_lines(spark, line(row_id="1", sales=None), line(row_id="2"))
    assert ids(clean(df)) == [2]


def test_survivor_is_the_lowest_row_id_in_any_layout(spark):
    rows = [line(row_id=str(i), product_name=f"copy {i}") for i in range(50, 0, -1)]
    for parts in (1, 3, 8):
        assert ids(clean(text_lines(spark, *rows).repartition(parts))) == [1]


def test_identical_copies_collapse_to_one(spark):
    assert clean(text_lines(spark, GOOD, GOOD, GOOD)).count() == 1


def test_blank_keys_are_rejected(spark):
    df = text_lines(spark, line(order_id="   "), line(customer_id=""), line(product_id=" "))
    assert clean(df).count() == 0
    reasons = {r.reject_reason for r in quality.quarantine(df).collect()}
    assert reasons == {"blank_key"}
    assert clean(df, BATCH_V1).count() == 3


@pytest.mark.parametrize("change, batch, stream", [
    ({"sales": "0"}, 1, 0),
    ({"discount": "1.0"}, 1, 1),
    ({"discount": "1.01"}, 1, 0),
    ({"discount": "-0.1"}, 1, 0),
    ({"discount": None}, 1, 0),
    ({"quantity": "0"}, 1, 0),
    ({"quantity": None}, 1, 0),
    ({"product_id": None}, 0, 1),
    ({"sales": "abc"}, 0, 0),
    ({"order_date": None}, 0, 0),
])
def test_batch_and_stream_rules(spark, change, batch, stream):
    df = text_lines(spark, line(**change))
    assert (clean(df, BATCH_V2).count(), clean(df, STREAM).count()) == (batch, stream)


def test_stream_keeps_duplicates_and_trims_postal_code(spark):
    rows = clean(text_lines(spark, line(postal_code=" 40917 "), line(row_id="2")), STREAM).collect()
    assert [r.postal_code for r in rows] == ["40917", "40917"]


def test_quarantine_and_valid_split_the_input(spark):
    df = faulty_lines(spark)
    for profile in (BATCH_V1, BATCH_V2, STREAM):
        kept = valid(prepared(df, profile), profile).count()
        rejected = quality.quarantine(df, profile).where("reject_reason IS NOT NULL")
        assert kept + rejected.count() == df.count()
    reasons = {r.row_id: r.reject_reason for r in quality.quarantine(df).collect() if r.reject_reason}
    assert reasons == {7001: "null_customer", 7003: "bad_date", 7004: "negative_sales", 7005: "null_order"}


def test_step_counts(spark):
    steps = {r.step: r for r in quality.step_counts(faulty_lines(spark)).collect()}
    assert steps["null_order"].rows_before == 6 and steps["null_order"].rows_removed == 1
    assert steps["negative_sales"].rows_after == 2
    assert steps["duplicate_key"].rows_removed == 1 and steps["duplicate_key"].rows_after == 1
    empty = quality.step_counts(faulty_lines(spark).limit(0)).collect()
    assert {r.rows_before for r in empty} == {0} and {r.rows_after for r in empty} == {0}


def test_duplicate_keys(spark):
    df = prepared(text_lines(spark, GOOD, line(row_id="2"), line(row_id="3", order_id="other")))
    assert [r.copies for r in quality.duplicate_keys(df).collect()] == [2]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_limited_before_the_shuffle(spark):
    """One key with most rows must not arrive whole at one task."""
    text = plan(deduplicated(prepared(text_lines(spark, GOOD))))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning(order_id")


def test_key_with_a_third_of_all_rows(spark):
    number = F.col("id").cast("string")
    wide = spark.range(0, 3000, 1, 6).select(*[
        {
            "row_id": number,
            "order_id": F.when(F.col("id") % 3 == 0, "hot").otherwise(number),
        }.get(c, F.lit(GOOD[c])).alias(c)
        for c in ORDER_LINE_COLUMNS
    ])
    kept = clean(wide)
    assert kept.count() == 2001
    assert kept.where("order_id = 'hot'").first().row_id == 0


def test_unique_lines_are_not_moved_to_find_duplicates(spark):
    rows = text_lines(spark, GOOD, line(row_id="0"), line(row_id="3", order_id="B"), line(row_id="4", order_id=None))
    found = deduplicated(prepared(rows))
    assert ids(found) == [0, 3, 4]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_lost_values_are_reported(spark):
    rows = text_lines(
        spark,
        GOOD,
        line(row_id="2", quantity="3.0"),
        line(row_id="3", profit="abc", ship_date="soon"),
        line(row_id="4", sales="0.1234567"),
        line(row_id="5", sales="2e14", profit="200000000000000.25"),
        line(row_id="6", sales="n/a"),
        line(row_id="7", discount=""),
        line(row_id="8", sales="123456789012345678901"),
        line(row_id="9", discount="100"),
    )
    report = {r.rule: r.violations for r in quality.full_report(rows).collect()}
    lost = {k: v for k, v in report.items() if k.startswith(("unreadable", "not_exact")) and v}
    assert lost == {
        "unreadable_quantity": 1, "unreadable_profit": 1, "unreadable_ship_date": 1,
        "not_exact_sales": 1, "unreadable_sales": 2,
    }
    found = {r.row_id: (r.flaws, r.reject_reason) for r in quality.quarantine(rows).collect()}
    assert found == {
        2: ("unreadable_quantity", None),
        3: ("unreadable_ship_date,unreadable_profit", None),
        4: ("not_exact_sales", None),
        6: ("unreadable_sales", "null_sales"),
        8: ("unreadable_sales", "null_sales"),
    }
    kept = {r.row_id: r for r in typed(rows).collect()}
    assert kept[5].sales == 2 * 10**14 and kept[5].profit == Decimal("200000000000000.25")
    assert kept[9].discount == 100


def typed_lines(spark, *rows: dict, **types: str):
    """Lines that come with types of their own, as from a typed table."""
    kinds = {"row_id": "long", "order_date": "date", "ship_date": "date", "postal_code": "long",
             "sales": "double", "quantity": "double", "discount": "double", "profit": "double"} | types
    text = text_lines(spark, *[{k: None if v is None else str(v) for k, v in line(**r).items()} for r in rows])
    return text.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in text.columns])


def test_typed_lines_report_what_they_lose(spark):
    rows = typed_lines(
        spark,
        {},
        {"row_id": 2, "sales": 0.12345678, "quantity": 3.7, "profit": 2e19},
        {"row_id": 3, "sales": "NaN", "discount": "Infinity"},
        {"row_id": 4, "sales": 0.1, "discount": 0.3333333, "quantity": 3e9},
        {"row_id": 5, "sales": 1e17, "profit": -0.000001},
    )
    found = {r.row_id: r.flaws for r in quality.quarantine(rows).collect()}
    assert found == {
        2: "not_exact_sales,not_exact_quantity,unreadable_profit",
        3: "unreadable_sales,unreadable_discount",
        4: "unreadable_quantity,not_exact_discount",
    }
    report = {r.rule: (r.violations, r.passed) for r in quality.flaw_report(rows).collect()}
    assert {k: v[0] for k, v in report.items() if v[0]} == {
        "not_exact_sales": 1, "not_exact_quantity": 1, "unreadable_profit": 1, "unreadable_sales": 1,
        "unreadable_discount": 1, "unreadable_quantity": 1, "not_exact_discount": 1,
    }
    assert report["not_exact_profit"] == (0, True) and "unreadable_row_id" not in report


def test_other_source_types(spark):
    rows = typed_lines(
        spark, {}, {"row_id": 2, "ship_date": "2016-11-19 08:30:00", "sales": "1.23456789", "quantity": 3_000_000_000},
        {"row_id": 3, "sales": "99999999999999999999999.5", "discount": 0.1},
        row_id="int", ship_date="timestamp", sales="decimal(38,8)", quantity="long", discount="float", profit="decimal(24,6)",
    )
    found = {r.row_id: r.flaws for r in quality.quarantine(rows).collect()}
    assert found == {2: "not_exact_ship_date,not_exact_sales,unreadable_quantity", 3: "unreadable_sales"}
    assert flaw_names(typed(rows)) == []
    assert quality.flaw_report(typed(rows)).collect() == [] and quality.flaw_report(typed(rows)).columns == ["rule", "violations", "passed"]
    assert quality.quarantine(typed(rows)).where("flaws <> ''").count() == 0


@pytest.mark.parametrize("text, lost", [
    ("0.1234567", "not_exact"), ("0.100000000", None), ("0.1000000000000000000000001", "not_exact"), ("1e-7", "not_exact"),
    ("1.5e-5", None), ("1.5E-6", "not_exact"), ("1e-25", "not_exact"), ("1000e-9", None), ("100e-9", "not_exact"),
    ("0e-30", None), ("12.50e3", None), ("1e17", None), ("1e18", "unreadable"), (" 7 ", None), ("-0.0000001", "not_exact"),
    ("1.2.3", "unreadable"), ("", None), ("   ", None), (None, None), ("000000000000000000000.5", None), ("0." + "0" * 30, None),
])
def test_text_amounts(spark, text, lost):
    found = text_lines(spark, line(sales=text)).select(F.array_join(flaws(text_lines(spark, line(sales=text))), ",").alias("f"))
    assert found.first().f == (f"{lost}_sales" if lost else "")


def test_survivors_of_every_kind_of_repetition(spark):
    """Two lines, many lines, lines that share a row_id, lines without one: as a window over all lines picks them."""
    rng = random.Random(6)
    rows = [
        line(row_id=rng.choice([None, *map(str, range(6))]), order_id=f"O{rng.randrange(60)}" if rng.random() < 0.9 else None,
             product_id="P", product_name=rng.choice("abc"), sales=str(rng.randrange(3)))
        for _ in range(240)
    ]
    df = prepared(text_lines(spark, *rows)).repartition(5)
    order = {"row_id": "asc"}
    for way in (order, {"row_id": "desc"}):
        found = unique_per_key(df, ["order_id", "product_id"], way)
        wanted = first_per_key(df, ["order_id", "product_id"], way)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_lines_are_read_once_where_row_ids_settle_all(spark, tmp_path):
    rows = text_lines(spark, GOOD, line(row_id="0"), line(row_id="3", order_id="B"), line(row_id="4", order_id="C"))
    rows.write.parquet(str(tmp_path / "bronze"))
    found = deduplicated(prepared(spark.read.parquet(str(tmp_path / "bronze"))))
    assert ids(found) == [0, 3, 4]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") <= 2


def test_whole_lines_stay_where_they_are(spark):
    """Only lines whose order is unsettled are shuffled, so no exchange holds whole lines of the rest."""
    found = deduplicated(prepared(text_lines(spark, GOOD, GOOD, line(row_id="3", order_id="B"))))
    text = plan(found)
    settled = text[: text.index("LeftSemi")]
    assert "LeftAnti" in settled and "BroadcastHashJoin" in settled and "SortMergeJoin" not in text
    assert found.count() == 2


def test_many_repeated_keys_are_not_broadcast(spark, monkeypatch):
    rows = text_lines(spark, GOOD, line(row_id="8"), line(row_id="9"), line(row_id="3", order_id="B"), line(row_id="4", order_id=None))
    expected = ids(deduplicated(prepared(rows)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
        assert "strategy=broadcast" in deduplicated(prepared(rows))._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
        found = deduplicated(prepared(rows))
        assert "strategy=broadcast" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert ids(found) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_splits_are_bounded_while_lines_are_written(spark):
    before = {s: spark.conf.get(s) for s in (sizing.PARTITIONS_SETTING, sizing.SPLIT_SETTING)}
    with sizing.sized_shuffles(spark, sizing.sized_lines(1 << 30)):
        assert spark.conf.get(sizing.SPLIT_SETTING) == f"{sizing.SPLIT_BYTES}b"
        assert int(spark.conf.get(sizing.PARTITIONS_SETTING)) == 64
    assert {s: spark.conf.get(s) for s in before} == before
    assert [sizing._bytes(x) for x in ("134217728b", "128MB", "16m", "5")] == [134217728, 128 << 20, 16 << 20, 5]
