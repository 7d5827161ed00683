"""Shapes of the physical plans: what is pushed down, split or avoided."""

import contextlib
import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from revtide import session
from revtide.operators.dedup import keep_first
from revtide.plans import cohorts, monthly, reports
from revtide.sources.landing import ARRIVAL, FLATTEN, read_landing
from revtide.sources.selection import children_of

AS_OF = dt.date(2021, 12, 31)


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Thresholds low enough that a few thousand test rows count as a skewed join
# of two large tables.
SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10000",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1000",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Subscriptions and invoices on disk; one subscription has a third of all
    invoices, one customer a third of all subscriptions."""
    folder = tmp_path_factory.mktemp("stored")
    subs = spark.range(6000).selectExpr(
        "concat('s', id) AS subscription_id",
        "IF(id % 3 = 0, 'hot', concat('c', id)) AS customer_id",
        "element_at(array('active', 'past_due', 'canceled'), int(id % 3 + 1)) AS status",
        "timestamp_seconds(1577836800 + id * 7200) AS start_date",
        "IF(id % 3 = 2, timestamp_seconds(1580836800 + id * 7200), NULL) AS canceled_at",
        "IF(id % 2 = 0, 'send_invoice', 'charge_automatically') AS collection_method",
        "double(id) / 8 AS mrr_amount",
    )
    invoices = spark.range(30000).selectExpr(
        "concat('i', id) AS invoice_id",
        "concat('s', IF(id % 3 = 0, 4, id % 6000)) AS subscription_id",
        "IF(id % 2 = 0, 'paid', 'open') AS status",
    )
    out = {}
    for name, frame in (("subs", subs), ("invoices", invoices)):
        frame.repartition(4).write.parquet(str(folder / name))
        out[name] = spark.read.parquet(str(folder / name))
    return out


def test_monthly_metrics_has_no_month_join(stored):
    text = plan(monthly.monthly_metrics(stored["subs"], AS_OF))
    assert "Join" not in text and "CartesianProduct" not in text
    assert "Python" not in text and "ObjectHashAggregate" not in text


def test_cohorts_have_no_join(stored):
    text = plan(cohorts.cohort_retention(stored["subs"], AS_OF))
    assert "Join" not in text and "Python" not in text


def test_scans_read_only_what_is_needed(stored):
    text = plan(reports.subscription_status_summary(stored["subs"]))
    assert "ReadSchema: struct<status:string,mrr_amount:double>" in text
    text = plan(reports.customer_churn_analysis(stored["subs"]))
    assert "EqualTo(status,canceled)" in text and "IsNotNull(canceled_at)" in text
    text = plan(reports.revenue_by_collection_method(stored["subs"], stored["invoices"], True))
    assert "In(status, [active,past_due])" in text


def test_keep_first_limits_before_the_shuffle(stored):
    kept = keep_first(stored["invoices"], "subscription_id", ["invoice_id"])
    text = plan(kept)
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2
    shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in shuffle and "Partial" in shuffle
    assert kept.count() == 4000


def test_hot_subscription_is_split_in_the_invoice_join(spark, stored):
    with settings(spark, **SKEWED):
        report = reports.revenue_by_collection_method(stored["subs"], stored["invoices"])
        assert "skew=true" in final_plan(report)
        skewed = [tuple(r) for r in report.collect()]
    fast = reports.revenue_by_collection_method(stored["subs"], stored["invoices"], True)
    assert skewed == [tuple(r) for r in fast.collect()]


def test_hot_parent_is_split_in_the_semi_join(spark, stored):
    parents = stored["subs"].select("customer_id").filter("customer_id IN ('hot', 'c1', 'c4')")
    with settings(spark, **SKEWED):
        kept = children_of(stored["subs"], parents, "customer_id")
        assert "skew=true" in final_plan(kept)
        assert kept.count() == 2002


def test_hot_customer_metrics_are_whole(stored):
    rows = monthly.monthly_metrics(stored["subs"], AS_OF).collect()
    subs = stored["subs"].filter(F.col("canceled_at").isNull())
    expected = subs.agg(F.countDistinct("customer_id").alias("n")).collect()[0].n
    assert rows[-1].active_customers == expected
    total = subs.agg(F.sum(F.col("mrr_amount").cast("decimal(18,6)")).cast("double").alias("t")).collect()[0].t
    assert rows[-1].total_mrr == total


class _Settings(dict):
    """A session's settings, none of them made by a user."""

    @property
    def conf(self):
        return self

    def set(self, key, value):
        self[key] = value


START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_reducers_start_high_unless_somebody_chose():
    assert session.configure(_Settings())[START] == "8192"
    assert session.configure(_Settings(), reducers=99)[START] == "99"
    for key in (START, "spark.sql.shuffle.partitions"):
        assert session.configure(_Settings({key: "7"})).get(START) == ("7" if key == START else None)


def test_reducers_are_merged_on_small_data(spark, stored):
    with settings(spark, spark__sql__adaptive__coalescePartitions__initialPartitionNum="512"):
        counted = stored["subs"].groupBy("customer_id").count()
        text = final_plan(counted)
        assert re.search(r"Exchange hashpartitioning\(customer_id#\d+, 512\)", text)
        assert "AQEShuffleRead coalesced" in text and counted.rdd.getNumPartitions() < 20


def test_load_shuffles_twice(spark, tmp_path):
    lines = [json.dumps({"id": f"i{n}", "customer": "a", "status": "paid", "created": 1}) for n in range(50)]
    (tmp_path / "part.json").write_text("\n".join(lines))
    raw = read_landing(spark, "invoices", str(tmp_path))
    parents = spark.createDataFrame([("a",)], "customer string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        flat = FLATTEN["invoices"](children_of(raw, parents, "customer"), dt.datetime(2021, 1, 1))
        rows = keep_first(flat, "invoice_id", [ARRIVAL]).sortWithinPartitions("status", "customer_id")
        text = plan(rows)
    # One exchange for each side of the semi join, one for keep-first.
    assert text.count("Exchange hashpartitioning") == 3 and "rangepartitioning" not in text
