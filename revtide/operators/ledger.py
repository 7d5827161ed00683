"""Customer ledgers: acquisition cohorts, plans, billing periods, running revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.months import BILLING_PERIOD_DAYS


def acquisitions(subscriptions: DataFrame) -> DataFrame:
    """Each customer's first month and standing.

    A customer with any active subscription is active, else past due with any
    past-due one, else canceled.  Everything is a counter or a minimum, so the
    aggregation hashes and starts in the map tasks.
    """
    status = F.col("status")
    per_customer = subscriptions.groupBy("customer_id").agg(
        F.min("start_date").alias("first_start"),
        F.count_if(status == "active").alias("active"),
        F.count_if(status == "past_due").alias("past_due"),
    )
    standing = F.when(F.col("active") > 0, "active").when(F.col("past_due") > 0, "past_due").otherwise("canceled")
    return per_customer.select(
        "customer_id", F.date_format("first_start", "yyyy-MM").alias("acquisition_month"), standing.alias("status")
    )


def acquisition_pivot(subscriptions: DataFrame) -> DataFrame:
    """Customers per acquisition month, in total and by standing."""
    status = F.col("status")
    return (
        acquisitions(subscriptions)
        .groupBy("acquisition_month")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            *[F.count_if(status == s).alias(s) for s in ("active", "canceled", "past_due")],
        )
        .orderBy("acquisition_month")
    )


def status_share(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions per status and their percentage of all."""
    counted = subscriptions.groupBy("status").agg(F.count(F.lit(1)).alias("subscriptions"))
    # One row per status by now.
    share = F.expr("try_divide(100 * subscriptions, sum(subscriptions) OVER ())")
    return counted.withColumn("share_percent", share).orderBy("status")


def plan_distribution(subscriptions: DataFrame, products: DataFrame) -> DataFrame:
    """Active subscriptions per plan and their percentage; plans without any are listed too."""
    active = (
        subscriptions.filter(F.col("status") == "active")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("subscriptions"))
    )
    named = products.select("product_id", F.col("name").alias("plan")).join(active, "product_id", "left")
    per_plan = named.groupBy("plan").agg(F.coalesce(F.sum("subscriptions"), F.lit(0)).alias("subscriptions"))
    # One row per plan by now.
    share = F.expr("coalesce(try_divide(100 * subscriptions, sum(subscriptions) OVER ()), 0D)")
    return per_plan.withColumn("share_percent", share).orderBy("plan")


def invoices_per_acquisition_month(subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """Customers of each acquisition month and all their invoices.

    Invoices are counted per customer before the join.
    """
    per_customer = invoices.groupBy("customer_id").agg(F.count(F.lit(1)).alias("invoices"))
    return (
        acquisitions(subscriptions)
        .join(per_customer, "customer_id", "left")
        .groupBy("acquisition_month")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.coalesce(F.sum("invoices"), F.lit(0)).alias("invoices"),
        )
        .orderBy("acquisition_month")
    )


def running_net_mrr(metrics: DataFrame) -> DataFrame:
    """New and churned revenue per month, and new minus churned accumulated; from the monthly metrics."""
    upto = Window.orderBy("month_year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Millionths add up exactly; one row per month.
    net = F.sum((F.col("new_mrr") - F.col("churned_mrr")).cast("decimal(24,6)")).over(upto).cast("double")
    return metrics.select("month_year", "new_mrr", "churned_mrr", net.alias("net_mrr")).orderBy("month_year")


def billing_periods(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per 30-day period a subscription was billed for.

    A period is billed when it begins, up to and including the cancel day or
    ``as_of``.
    """
    start = F.to_date("start_date")
    end = F.least(F.to_date("canceled_at"), F.lit(as_of))
    last = F.floor(F.datediff(end, start) / BILLING_PERIOD_DAYS).cast("int")
    numbered = subscriptions.select(
        "subscription_id", start.alias("_start"), last.alias("_last")
    ).filter((F.col("_last") >= 0))
    safe_last = F.greatest("_last", F.lit(0))
    return numbered.select(
        "subscription_id", "_start", F.explode(F.sequence(F.lit(0), safe_last)).alias("period_number")
    ).select(
        "subscription_id",
        "period_number",
        F.date_add("_start", F.col("period_number") * BILLING_PERIOD_DAYS).alias("period_start"),
    )
