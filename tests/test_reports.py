import datetime as dt

from pyspark.sql import functions as F

from revtide.plans import dashboard, reports

AT = dt.datetime


def subs(spark):
    return spark.createDataFrame(
        [
            ("s1", "a", "active", "auto", "p1", "d1", 10.0, AT(2020, 1, 1), None),
            ("s2", "a", "active", "auto", "p1", "d1", 20.0, AT(2020, 1, 5), None),
            ("s3", "b", "past_due", "auto", "p2", "d1", 5.0, AT(2020, 2, 5), None),
            ("s4", "c", "canceled", "mail", "p2", "d2", 7.0, AT(2020, 1, 1), AT(2020, 3, 1)),
            ("s5", "c", "canceled", "mail", None, None, 0.0, AT(2020, 1, 1), AT(2020, 3, 11)),
            ("s6", "d", "canceled", "mail", "p2", "d2", 7.0, AT(2020, 1, 1), None),
            ("s7", "e", "active", None, "p3", "d2", 1.5, AT(2020, 1, 1), None),
        ],
        "subscription_id string, customer_id string, status string, collection_method string, "
        "price_id string, product_id string, mrr_amount double, start_date timestamp, canceled_at timestamp",
    )


def invoices(spark, *more):
    rows = [("i1", "s1", "paid"), ("i2", "s1", "open"), ("i3", "s3", "paid"), ("i4", None, "paid"), *more]
    return spark.createDataFrame(rows, "invoice_id string, subscription_id string, status string")


def as_tuples(frame):
    return [tuple(r) for r in frame.collect()]


def test_plans(spark):
    prices = spark.createDataFrame(
        [("p1", "N", 10), ("p2", "N", 20), ("p3", "N", 30)],
        "price_id string, nickname string, unit_amount long",
    )
    products = spark.createDataFrame([("d1", "One"), ("d2", "Two")], "product_id string, name string")
    assert as_tuples(reports.mrr_by_plan(subs(spark), prices, products)) == [
        ("One", "N", 1, 30.0, 15.0), ("Two", "N", 1, 1.5, 1.5),
    ]
    doubled = prices.union(prices.filter("price_id = 'p3'"))
    assert as_tuples(reports.mrr_by_plan_no_amount(subs(spark), doubled, products)) == [
        ("One", "N", 1, 30.0), ("Two", "N", 1, 3.0),
    ]


def test_churn_and_status(spark):
    assert as_tuples(reports.customer_churn_analysis(subs(spark))) == [(dt.date(2020, 3, 1), 2, 7.0, 65.0)]
    assert as_tuples(reports.subscription_status_summary(subs(spark))) == [
        ("active", 3, 31.5), ("canceled", 3, 14.0), ("past_due", 1, 5.0),
    ]


def test_collection_method(spark):
    expected = [(None, 1, 1.5, 0, 0, None), ("auto", 2, 45.0, 3, 2, 2 / 3 * 100)]
    once = [(None, 1, 1.5, 0, 0, None), ("auto", 2, 35.0, 3, 2, 2 / 3 * 100)]
    for unique in (True, False):
        rows = reports.revenue_by_collection_method(subs(spark), invoices(spark), unique)
        assert as_tuples(rows) == expected
        rows = reports.revenue_by_collection_method_unfanned(subs(spark), invoices(spark), unique)
        assert as_tuples(rows) == once


def test_collection_method_with_repeated_ids(spark):
    repeated = invoices(spark, ("i3", "s1", "open"), ("i1", "s1", "paid"), (None, "s3", "paid"))
    rows = reports.revenue_by_collection_method(subs(spark), repeated)
    # s1 has four invoice rows, s2 none, s3 two; three distinct ids, two of them paid.
    assert as_tuples(rows)[1] == ("auto", 2, 10.0 * 4 + 20.0 + 5.0 * 2, 3, 2, 2 / 3 * 100)


def summary(spark, n=2):
    rows = [
        ("2020-01", dt.date(2020, 1, 1), 1000.0, 1000.0, 0.0, 0.0, 0.0, 1000.0, 4, 4, 0, 250.0, 0.0, 0.0),
        ("2020-02", dt.date(2020, 2, 1), 1500.5, 600.0, 0.0, 0.0, 99.5, 500.5, 5, 2, 1, 300.1, 0.2, 50.05),
    ]
    columns = (
        "month_year string, month_start_date date, total_mrr double, new_mrr double, expansion_mrr double, "
        "contraction_mrr double, churned_mrr double, net_new_mrr double, active_customers long, "
        "new_customers long, churned_customers long, average_revenue_per_user double, churn_rate double, "
        "growth_rate double"
    )
    return spark.createDataFrame(rows[:n], columns)


def test_trends(spark):
    trend = dashboard.api_mrr_trend(summary(spark))
    last = trend.collect()[1]
    assert (last.monthLabel, last.churnRate, last.arpu) == ("Feb 2020", 20.0, 300.1)
    assert as_tuples(dashboard.monthly_table(trend)) == [
        ("2020-01", "$1,000", "+$1,000", "-$0", "$1,000", 4, "-"),
        ("2020-02", "$1,501", "+$600", "-$100", "$501", 5, "+50.0%"),
    ]
    assert reports.mrr_growth_trend(summary(spark)).columns[-1] == "churn_rate"
    assert len(reports.mrr_trend_analysis(summary(spark)).columns) == 11
    assert reports.growth_trend_inline(summary(spark)).count() == 2
    points = dashboard.chart_series(trend)
    assert points.count() == 10
    ticks = points.filter(F.col("tick").isNotNull()).select("tick").collect()
    assert [r.tick for r in ticks] == ["$1k", "$1.5005k"]


def test_summary_and_cards(spark):
    row = dashboard.api_summary(summary(spark), subs(spark))
    (latest,) = row.collect()
    assert (latest.currentMrr, latest.activeCustomers) == (1500.5, 5)
    assert latest.subscriptions.asDict() == {"active": 3, "canceled": 3, "pastDue": 1}
    assert as_tuples(dashboard.kpi_cards(row)) == [
        (1, "Current MRR", "$1,501", None, "↑ 50.0% from last month"),
        (2, "Active Customers", "5", "1 past due", None),
        (3, "ARPU", "$300", "Average Revenue Per User", None),
        (4, "Churn Rate", "20.0%", "3 canceled", None),
    ]
    assert dashboard.api_summary(summary(spark, 0), subs(spark)).collect() == []
    assert as_tuples(dashboard.pie_series(subs(spark)))[2] == ("Past due", 1)
