import datetime as dt
import random

import pytest

from revtide.operators.activity import customer_bitmaps
from revtide.plans.cohorts import cohort_retention, cohort_table
from revtide.plans.monthly import monthly_metrics, monthly_summary
from tests import brute

D = dt.date
SCHEMA = "subscription_id string, customer_id string, start_date timestamp, canceled_at timestamp, mrr_amount double"


def sub(customer, start, cancel=None, mrr=10.0):
    return {"customer": customer, "start": start, "cancel": cancel, "mrr": mrr}


def frame(spark, subs):
    at = lambda d: d and dt.datetime(d.year, d.month, d.day, 13, 30)
    rows = [
        (f"s{i}", s["customer"], at(s["start"]), at(s["cancel"]), s["mrr"]) for i, s in enumerate(subs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


BOUNDARIES = {
    "start on the first": [sub("a", D(2020, 1, 1)), sub("b", D(2020, 2, 1))],
    "start is cancel day": [sub("a", D(2020, 1, 5)), sub("b", D(2020, 2, 5), D(2020, 2, 5))],
    "cancel on the first": [sub("a", D(2020, 1, 10), D(2020, 3, 1))],
    "cancel in start month": [sub("a", D(2020, 1, 2), D(2020, 1, 30)), sub("b", D(2020, 1, 3))],
    "cancel after as_of": [sub("a", D(2020, 1, 2), D(2021, 1, 30))],
    "cancel before start": [sub("a", D(2020, 3, 2), D(2020, 1, 30)), sub("b", D(2020, 1, 3))],
    "overlap and gap": [
        sub("a", D(2020, 1, 2), D(2020, 4, 1), 5.5),
        sub("a", D(2020, 2, 2), D(2020, 3, 1), 7.25),
        sub("a", D(2020, 6, 15), None, 0.125),
    ],
    "null start": [sub("a", None, D(2020, 2, 2)), sub("b", D(2020, 1, 3)), sub("c", None)],
    "start after as_of": [sub("a", D(2020, 1, 3), D(2020, 1, 9)), sub("b", D(2020, 9, 1))],
    "quiet months": [sub("a", D(2019, 1, 3), D(2019, 1, 9)), sub("b", D(2020, 5, 2))],
    "as_of before all": [sub("a", D(2022, 1, 3))],
    "word borders": [sub("a", D(1999, 12, 1), D(2020, 7, 3)), sub("b", D(2003, 11, 30), D(2014, 8, 1))],
}
AS_OF = D(2020, 7, 31)


def block_borders():
    """Customers whose first starts walk over several bitmap blocks, with later
    runs inside, at the end of and after their first year."""
    subs = []
    for i in range(160):
        year, month = 2006 + i // 12, i % 12 + 1
        first = D(year, month, 1 + i % 3)
        subs.append(sub(f"c{i}", first, first + dt.timedelta(20 + i % 50)))
        for gap in (300, 365, 380, 420):
            if (i + gap) % 3:
                later = first + dt.timedelta(gap)
                subs.append(sub(f"c{i}", later, later + dt.timedelta(15)))
    return subs


def check(spark, subs, as_of):
    rows = monthly_metrics(frame(spark, subs), as_of).collect()
    got = [
        (
            r.month_start_date, r.total_mrr, r.new_mrr, r.churned_mrr, r.active_customers,
            r.new_customers, r.churned_customers, r.prev_month_mrr,
        )
        for r in rows
    ]
    assert got == brute.monthly(subs, as_of)
    for r in rows:
        assert r.net_new_mrr == r.new_mrr - r.churned_mrr
        assert r.month_year == r.month_start_date.strftime("%Y-%m")
        if r.active_customers:
            assert r.churn_rate == r.churned_customers / r.active_customers
        else:
            assert r.churn_rate is None and r.average_revenue_per_user is None
    kept = [
        (r.cohort_start_date, r.period_number, r.customers_in_cohort, r.active_customers)
        for r in cohort_retention(frame(spark, subs), as_of).collect()
    ]
    assert kept == brute.cohorts(subs, as_of)


@pytest.mark.parametrize("name", BOUNDARIES)
def test_boundaries(spark, name):
    check(spark, BOUNDARIES[name], AS_OF)


def random_ledger(seed):
    rng = random.Random(seed)
    day = lambda: D(2018, 1, 1) + dt.timedelta(rng.randrange(900))
    first = lambda d: d.replace(day=1) if rng.random() < 0.3 else d
    subs = []
    for _ in range(rng.randrange(5, 60)):
        start = first(day()) if rng.random() < 0.95 else None
        cancel = first(day()) if rng.random() < 0.5 else None
        # A third of all rows belong to one customer.
        customer = "hot" if rng.random() < 0.33 else f"c{rng.randrange(12)}"
        subs.append(sub(customer, start, cancel, rng.randrange(10**6) / 1000))
    return subs, day()


def test_block_borders(spark):
    check(spark, block_borders(), AS_OF)


@pytest.mark.parametrize("seed", range(8))
def test_random_ledgers(spark, seed):
    check(spark, *random_ledger(seed))


def test_no_rows(spark):
    empty = frame(spark, [])
    assert monthly_metrics(empty, AS_OF).collect() == []
    assert cohort_retention(empty, AS_OF).collect() == []


def test_first_of_month_counts_a_month_early(spark):
    rows = monthly_metrics(frame(spark, [sub("a", D(2020, 1, 9)), sub("b", D(2020, 2, 1))]), D(2020, 2, 9))
    assert [(r.active_customers, r.new_customers) for r in rows.collect()] == [(2, 1), (2, 1)]


def test_summary_fills_and_growth(spark):
    subs = [sub("a", D(2020, 1, 9), D(2020, 2, 9), 10.0), sub("b", D(2020, 4, 2), None, 30.0)]
    rows = monthly_summary(frame(spark, subs), D(2020, 6, 1), dt.datetime(2020, 6, 2)).collect()
    # February has no active customer left; March has no activity at all.
    assert [r.month_year for r in rows] == ["2020-01", "2020-02", "2020-04", "2020-05", "2020-06"]
    assert [r.growth_rate for r in rows] == [0.0, -100.0, 0.0, 0.0, 0.0]
    assert [r.churn_rate for r in rows] == [0.0, 0.0, 0.0, 0.0, 0.0]
    assert rows[1].average_revenue_per_user == 0.0 and rows[1].churned_customers == 1
    assert rows[0].calculated_at == dt.datetime(2020, 6, 2)


def test_cohort_table_keeps_empty_periods(spark):
    rows = cohort_table(frame(spark, [sub("a", D(2020, 1, 9), D(2020, 2, 9))]), D(2020, 4, 1)).collect()
    assert [(r.period_number, r.active_customers) for r in rows] == [(0, 1), (1, 1), (2, 0), (3, 0)]
    assert all(r.cohort_revenue == 0.0 and r.customers_in_cohort == 1 for r in rows)


def test_hot_customer_collapses_before_the_shuffle(spark):
    subs = [sub("hot", D(2020, 1 + i % 7, 1 + i % 28)) for i in range(3000)]
    subs += [sub(f"c{i}", D(2020, 3, 3)) for i in range(300)]
    wide = frame(spark, subs).repartition(4)
    bitmaps = customer_bitmaps(wide, AS_OF)
    per_customer = bitmaps.groupBy("customer_id").count().filter("customer_id = 'hot'").collect()
    assert per_customer[0]["count"] == 1
    metrics = monthly_metrics(wide, AS_OF).collect()
    assert metrics[-1].active_customers == 301


def test_stamps_are_utc_on_any_machine(spark):
    from revtide.functions.months import utc

    (row,) = spark.range(1).select(utc(dt.datetime(2020, 1, 1)).cast("bigint").alias("x")).collect()
    assert row.x == 1577836800
    # The same instant when the driver's own zone is another one.
    import os
    import time

    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        (row,) = spark.range(1).select(utc(dt.datetime(2020, 1, 1)).cast("bigint").alias("x")).collect()
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert row.x == 1577836800
