import datetime as dt
import json

import pytest

from revtide import schemas
from revtide.operators.checks import conform, required_violations
from revtide.operators.dedup import keep_first
from revtide.sources.landing import ARRIVAL, FLATTEN, read_landing
from revtide.sources.selection import (
    children_of,
    created_since,
    first_nonempty,
    referenced_entities,
    union_sources,
)

STAMP = dt.datetime(2024, 5, 6, 7, 8, 9)


def at(seconds):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)


@pytest.fixture
def flatten(spark, tmp_path):
    def run(entity, *objects):
        path = tmp_path / f"{entity}.json"
        path.write_text("\n".join(json.dumps(o) for o in objects))
        raw = read_landing(spark, entity, str(path))
        flat = FLATTEN[entity](raw, STAMP)
        return [r.asDict() for r in flat.orderBy(ARRIVAL).drop(ARRIVAL).collect()]

    return run


def item(quantity=2, amount=1200, interval="month", **more):
    price = {"id": "p1", "product": "prod", "unit_amount": amount}
    if interval:
        price["recurring"] = {"interval": interval, "interval_count": 1}
    return {"quantity": quantity, "price": price, **more}


def subscription(**more):
    base = {"id": "s1", "customer": "c1", "status": "active", "start_date": 1000, "created": 900}
    return {**base, **more}


def items(*entries):
    return {"items": {"data": list(entries)}}


def test_subscription_amounts(flatten):
    rows = flatten(
        "subscriptions",
        subscription(**items(item())),
        subscription(**items(item(interval="year"))),
        subscription(**items(item(interval="week"))),
        subscription(**items(item(interval="day"))),
        subscription(**items(item(interval=None))),
        subscription(**items(item(quantity=0))),
        subscription(**items(item(amount=None))),
        subscription(**items(item(amount=500), item(amount=90000))),
        subscription(items={"data": []}),
        subscription(),
    )
    assert [r["mrr_amount"] for r in rows] == [
        24.0, 2400 / 12 / 100, 2400 * 4.33 / 100, 0.0, 0.0, 12.0, 0.0, 10.0, 0.0, 0.0,
    ]
    assert [r["quantity"] for r in rows] == [2, 2, 2, 2, 2, 1, 2, 2, 1, 1]
    assert [r["unit_amount"] for r in rows] == [1200] * 6 + [0, 500, None, None]
    assert rows[8]["price_id"] is None and rows[0]["price_id"] == "p1"


def test_interval_defaults(flatten):
    bare = item()
    bare["price"]["recurring"] = {"interval_count": 1}
    empty = item()
    empty["price"]["recurring"] = {}
    rows = flatten("subscriptions", subscription(**items(bare)), subscription(**items(empty)))
    assert [r["mrr_amount"] for r in rows] == [24.0, 0.0]


def test_item_without_price_is_unreadable(flatten):
    broken = {"quantity": 1}
    rows = flatten("subscriptions", subscription(**items(broken)), subscription(id="s2"))
    assert [r["subscription_id"] for r in rows] == ["s2"]


def test_subscription_times_and_defaults(flatten):
    rows = flatten(
        "subscriptions",
        subscription(**items(item(current_period_start=5000, current_period_end=6000))),
        subscription(billing_cycle_anchor=4000, **items(item(current_period_start=0))),
        subscription(**items(item())),
        {"id": "s", "customer": "c", "status": "canceled", "created": 700, "canceled_at": 800,
         "ended_at": 810, "currency": "eur", "cancel_at_period_end": True},
        {"id": "s", "customer": "c", "status": "active", "start_date": 0, "canceled_at": 0},
    )
    assert [r["current_period_start"] for r in rows] == [at(5000), at(4000), at(1000), at(700), STAMP]
    assert [r["current_period_end"] for r in rows] == [at(6000), at(4000), at(1000), at(700), STAMP]
    assert [r["start_date"] for r in rows] == [at(1000)] * 3 + [STAMP, STAMP]
    assert [r["created"] for r in rows] == [at(900)] * 3 + [at(700), STAMP]
    assert [r["canceled_at"] for r in rows] == [None] * 3 + [at(800), None]
    assert [r["currency"] for r in rows] == ["usd"] * 3 + ["eur", "usd"]
    assert [r["cancel_at_period_end"] for r in rows] == [False] * 3 + [True, False]
    assert {r["extracted_at"] for r in rows} == {STAMP}


def test_customer_clock_and_settings(flatten):
    base = {"email": "e", "name": "n", "created": 60, "currency": "usd", "delinquent": False}
    rows = flatten(
        "customers",
        {"id": "a", "test_clock": {"id": "clock_1", "object": "clock"}, **base},
        {"id": "b", "test_clock": "clock_2", "invoice_settings": {"default_payment_method": "pm"}, **base},
        {"id": "c", "invoice_settings": {"default_payment_method": None}, **base},
    )
    assert [r["test_clock_id"] for r in rows] == ["clock_1", "clock_2", None]
    assert [r["default_payment_method"] for r in rows] == [None, "pm", None]
    assert rows[0]["created"] == at(60)


def test_invoice_price_product(flatten):
    invoice = {
        "id": "i", "number": "N1", "customer": "c", "status": "paid", "total": 5, "created": 50,
        "due_date": 0, "period_start": 10, "status_transitions": {"paid_at": 99},
    }
    rows = flatten("invoices", invoice, {**invoice, "status_transitions": None, "subscription": "s"})
    assert [(r["paid_at"], r["due_date"], r["period_start"], r["subscription_id"]) for r in rows] == [
        (at(99), None, at(10), None), (None, None, at(10), "s"),
    ]
    price = {"id": "p", "product": "d", "active": True, "currency": "usd", "unit_amount": 5, "created": 1}
    rows = flatten("prices", price, {**price, "recurring": {"interval": "year", "interval_count": 2}})
    assert [(r["recurring_interval"], r["recurring_interval_count"]) for r in rows] == [
        (None, None), ("year", 2),
    ]
    rows = flatten("products", {"id": "d", "name": "n", "active": True, "created": 1, "updated": 2})
    assert rows[0]["updated"] == at(2)


def test_keep_first_follows_file_order(spark, tmp_path):
    folder = tmp_path / "subs"
    folder.mkdir()
    for name, statuses in (("a.json", ("active", "canceled")), ("b.json", ("past_due", "other"))):
        lines = [json.dumps(subscription(id=f"s{i}", status=s)) for i, s in enumerate(statuses)]
        lines += [json.dumps(subscription(id="s1", status="late"))]
        (folder / name).write_text("\n".join(lines))
    flat = FLATTEN["subscriptions"](read_landing(spark, "subscriptions", str(folder)), STAMP)
    kept = keep_first(flat, "subscription_id", [ARRIVAL]).select("subscription_id", "status")
    assert sorted(map(tuple, kept.collect())) == [("s0", "active"), ("s1", "canceled")]


def test_selection(spark):
    customers = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "customer_id string, n int")
    invoices = spark.createDataFrame([("b",), (None,), ("b",), ("z",)], "customer string")
    assert referenced_entities(customers, "customer_id", invoices, "customer").count() == 2
    children = spark.createDataFrame([("s", "b"), ("t", "x"), ("u", None)], "id string, customer_id string")
    assert [r.id for r in children_of(children, customers, "customer_id").collect()] == ["s"]
    swapped = customers.select("n", "customer_id")
    assert union_sources(customers, swapped).count() == 6
    none = customers.filter("n > 9")
    reached = []
    second = lambda: reached.append(1) or customers.filter("n = 1")
    assert first_nonempty(none, second, customers).count() == 1
    assert first_nonempty(customers, second).count() == 3 and len(reached) == 1
    assert first_nonempty(none, none).count() == 0
    stamped = customers.selectExpr("timestamp_seconds(n) AS created")
    assert created_since(stamped, at(2)).count() == 2


def test_required_columns(spark):
    rows = spark.createDataFrame(
        [("p", "n", None), (None, "n", None), (None, None, None)],
        "product_id string, name string, description string",
    ).selectExpr("*", "true AS active", "timestamp_seconds(1) AS created",
                 "timestamp_seconds(1) AS updated", "timestamp_seconds(1) AS extracted_at")
    found = {r.column_name: r.violations for r in required_violations(rows, schemas.PRODUCTS, "products").collect()}
    assert found == {"product_id": 2, "name": 1, "created": 0, "extracted_at": 0}
    assert conform(rows.limit(1), schemas.PRODUCTS, "products").count() == 1
    with pytest.raises(Exception, match="products.product_id is required but null"):
        conform(rows, schemas.PRODUCTS, "products").collect()


def test_the_interval_of_a_subscription_is_read_once(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(subscription(**items(item()))))
    flat = FLATTEN["subscriptions"](read_landing(spark, "subscriptions", str(tmp_path / "s.json")), STAMP)
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("jsonObjectKeys(") == 1 and plan.count("get_json_object(") == 1
