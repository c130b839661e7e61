"""Random order lines through every layer, against plain Python loops."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal, InvalidOperation

import pytest

from orderloom.operators import forecast, measures, quality, star
from orderloom.operators.cleaning import clean, prepared
from orderloom.schema import BATCH_V1, BATCH_V2, STREAM
from tests.lines import line, text_lines


def random_lines(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        customer = pick.choice([None, "", " ", "C1", " C1", "C2", "C3 ", "C4", "C5"])
        product = pick.choice([None, "P1", "P2 ", "P3", "  ", "P4", "P5", "P6"])
        rows.append(line(
            row_id=str(i if pick.random() < 0.9 else i - 1),
            order_id=pick.choice([None, "  "] + [f"O{j}" for j in range(40)]),
            order_date=pick.choice(["08-11-2016", None, "2016-02-30"]
                                   + [f"201{y}-{m:02d}-15" for y in (6, 7) for m in (1, 2, 11, 12)]),
            customer_id=customer,
            customer_name=pick.choice(["Ann", "Ann ", "Bob", "Cy"]),
            segment=pick.choice(["Consumer", "Corporate"]),
            product_id=product,
            product_name=pick.choice(["A", "B"]),
            category=pick.choice(["Seating", "Technology", "Office"]),
            region=pick.choice(["West", "East"]),
            sales=pick.choice(["abc", None, "-1", "0", "10.01", "99.9999", "1e2"]),
            quantity=pick.choice(["0", "1", "7", None]),
            discount=pick.choice(["0", "0.25", "1.0", "1.01", None]),
            profit=pick.choice(["-3.5", "0", "12.3456"]),
        ))
    return rows


def date(text):
    try:
        return dt.datetime.strptime(text or "", "%Y-%m-%d").date()
    except ValueError:
        return None


def number(text):
    try:
        return Decimal(text)
    except (InvalidOperation, TypeError):
        return None


def trim(text):
    return text if text is None else text.strip(" ")


def parsed(row):
    out = {k: trim(v) for k, v in row.items()}
    out["row_id"] = int(row["row_id"])
    out["order_date"], out["ship_date"] = date(row["order_date"]), date(row["ship_date"])
    for c in ("sales", "discount", "profit", "quantity"):
        out[c] = number(row[c])
    return out


def reason(r, profile):
    if r["order_id"] is None:
        return "null_order"
    if r["customer_id"] is None:
        return "null_customer"
    if profile is not STREAM and r["product_id"] is None:
        return "null_product"
    keys = ["order_id", "customer_id"] + ([] if profile is STREAM else ["product_id"])
    if profile is not BATCH_V1 and any(r[k] == "" for k in keys):
        return "blank_key"
    if r["sales"] is None:
        return "null_sales"
    if profile is BATCH_V1:
        return None
    if r["order_date"] is None:
        return "bad_date"
    if profile is BATCH_V2:
        return "negative_sales" if r["sales"] < 0 else None
    if r["sales"] <= 0:
        return "sales_not_positive"
    if r["quantity"] is None or r["quantity"] <= 0:
        return "quantity_not_positive"
    if r["discount"] is None or not 0 <= r["discount"] <= 1:
        return "discount_out_of_range"
    return None


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    rows = random_lines(request.param)
    return text_lines(spark, *rows).repartition(5).cache(), [parsed(r) for r in rows]


@pytest.mark.parametrize("profile", [BATCH_V1, BATCH_V2, STREAM], ids=lambda p: p.name)
def test_reasons_and_survivors(data, profile):
    df, rows = data
    quarantined = quality.quarantine(df, profile).where("reject_reason IS NOT NULL").collect()
    got = sorted((r.row_id, r.reject_reason) for r in quarantined)
    assert got == sorted((r["row_id"], reason(r, profile)) for r in rows if reason(r, profile))
    good = [r for r in rows if reason(r, profile) is None]
    if profile is STREAM:
        assert clean(df, profile).count() == len(good)
        return
    lowest = defaultdict(lambda: 10**9)
    for r in good:
        key = (r["order_id"], r["product_id"])
        lowest[key] = min(lowest[key], r["row_id"])
    kept = {(r.order_id, r.product_id): r.row_id for r in clean(df, profile).collect()}
    assert kept == dict(lowest)


def test_report_and_steps(data):
    df, rows = data
    report = {r.rule: r.violations for r in quality.rule_report(prepared(df)).collect()}
    keyed = [(r["order_id"], r["product_id"]) for r in rows if r["order_id"] is not None and r["product_id"] is not None]
    assert report["duplicate_key"] == len(keyed) - len(set(keyed))
    assert report["bad_date"] == sum(r["order_date"] is None for r in rows)
    assert report["negative_sales"] == sum(r["sales"] is None or r["sales"] < 0 for r in rows)
    steps = quality.step_counts(df).orderBy("step_number").collect()
    assert steps[0].rows_before == len(rows) and steps[-1].rows_after == clean(df).count()
    assert all(a.rows_after == b.rows_before for a, b in zip(steps, steps[1:]))


def test_star_measures_and_trend(data):
    df, _ = data
    silver = clean(df).cache()
    lines = silver.collect()
    newest = {}
    for r in sorted(lines, key=lambda r: (-r.order_date.toordinal(), r.row_id)):
        newest.setdefault(r.customer_id, (r.customer_name, r.segment))
    customers = {r.customer_id: (r.customer_name, r.segment) for r in star.dim_customer(silver).collect()}
    ties = {(r.customer_id, r.order_date, r.row_id) for r in lines}
    if len(ties) == len(lines):
        assert customers == newest
    assert set(customers) == set(newest)

    fact, dates = star.fact_orders(silver), star.dim_date(silver)
    assert fact.count() == len(lines)
    orders = defaultdict(set)
    for r in lines:
        orders[r.customer_id].add(r.order_id)
    kpi = measures.kpi_customer(fact).first()
    assert kpi.total_customers == len(orders)
    assert kpi.repeat_customers == sum(len(o) > 1 for o in orders.values())
    summary = measures.kpi_summary(fact).first()
    assert summary.total_sales == float(sum(r.sales for r in lines))
    assert summary.total_orders == len({r.order_id for r in lines})

    months = defaultdict(Decimal)
    for r in lines:
        months[(r.order_date.year - 2015) * 12 + r.order_date.month] += r.sales
    got = {r.month_index: r.total_sales for r in forecast.monthly_sales(fact, dates).collect()}
    assert got == {m: float(round(s, 2)) for m, s in months.items()}
