"""Plan, churn, payment-method and status reports over the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions.money import exact_sum, exact_sum_sql, ratio
from revtide.functions.months import month_start

PAYING = ("active", "past_due")


def _active_with_plan(
    subscriptions: DataFrame, prices: DataFrame, products: DataFrame
) -> DataFrame:
    """Active subscriptions with plan name and price.

    The dimensions are left to the planner: small ones are broadcast by size,
    large ones are shuffled and hot prices split by adaptive execution.
    """
    active = subscriptions.filter(F.col("status") == "active").select(
        "customer_id", "price_id", "product_id", "mrr_amount"
    )
    price = prices.select("price_id", F.col("nickname").alias("price_nickname"), "unit_amount")
    plan = products.select("product_id", F.col("name").alias("plan_name"))
    return active.join(price, "price_id").join(plan, "product_id")


def mrr_by_plan(subscriptions: DataFrame, prices: DataFrame, products: DataFrame) -> DataFrame:
    """One row per plan, nickname and unit amount; the amount is not shown.

    The average is per subscription.
    """
    rows = _active_with_plan(subscriptions, prices, products)
    total = exact_sum("mrr_amount")
    return (
        rows.groupBy("plan_name", "price_nickname", "unit_amount")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            total.alias("total_mrr"),
            ratio(total, F.count("mrr_amount")).alias("avg_mrr_per_customer"),
        )
        .orderBy(F.desc("total_mrr"), "plan_name", "price_nickname", "unit_amount")
        .drop("unit_amount")
    )


def mrr_by_plan_no_amount(
    subscriptions: DataFrame, prices: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per plan and nickname."""
    rows = _active_with_plan(subscriptions, prices, products)
    return (
        rows.groupBy("plan_name", "price_nickname")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            exact_sum("mrr_amount").alias("total_mrr"),
        )
        .orderBy(F.desc("total_mrr"), "plan_name", "price_nickname")
    )


def customer_churn_analysis(subscriptions: DataFrame) -> DataFrame:
    """Canceled subscriptions per month of cancellation."""
    canceled_on, started_on = F.to_date("canceled_at"), F.to_date("start_date")
    lifetime = F.datediff(canceled_on, started_on)
    return (
        subscriptions.filter((F.col("status") == "canceled") & F.col("canceled_at").isNotNull())
        .groupBy(month_start(canceled_on).alias("churn_month"))
        .agg(
            F.count(F.lit(1)).alias("churned_customers"),
            exact_sum("mrr_amount").alias("churned_mrr"),
            ratio(F.sum(lifetime), F.count(lifetime)).alias("avg_lifetime_days"),
        )
        .orderBy("churn_month")
    )


def subscription_status_summary(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.groupBy("status")
        .agg(F.count(F.lit(1)).alias("count"), exact_sum("mrr_amount").alias("mrr"))
        .orderBy(F.desc("count"), "status")
    )


def _payment_columns(totals: DataFrame) -> DataFrame:
    rate = ratio(F.col("paid_invoices"), F.col("total_invoices")) * 100
    return totals.select(
        "collection_method",
        "customers",
        F.col("total_mrr").cast("double").alias("total_mrr"),
        "total_invoices",
        "paid_invoices",
        rate.alias("payment_success_rate"),
    )


def _paying(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.filter(F.col("status").isin(*PAYING)).select(
        "subscription_id", "customer_id", "collection_method", "mrr_amount"
    )


def _invoices_per_subscription(invoices: DataFrame) -> DataFrame:
    """Collapsed before the shuffle, so a subscription with very many invoices
    meets the join as one row."""
    return (
        invoices.filter(F.col("subscription_id").isNotNull())
        .groupBy("subscription_id")
        .agg(
            F.count(F.lit(1)).alias("invoices"),
            F.count("invoice_id").alias("named_invoices"),
            F.count_if((F.col("status") == "paid") & F.col("invoice_id").isNotNull()).alias(
                "paid_invoices"
            ),
        )
    )


def _distinct_invoices(paying: DataFrame, invoices: DataFrame) -> DataFrame:
    """Distinct and distinct paid invoices per method, for any invoice table.

    Both sides of the inner join can be split by adaptive execution; the
    grouping on the invoice id spreads every method over all reducers.
    """
    linked = invoices.filter(F.col("invoice_id").isNotNull()).select(
        "subscription_id", "invoice_id", (F.col("status") == "paid").alias("paid")
    )
    return (
        linked.join(paying.select("subscription_id", "collection_method"), "subscription_id")
        .groupBy("collection_method", "invoice_id")
        .agg(F.max("paid").alias("paid"))
        .groupBy("collection_method")
        .agg(
            F.count(F.lit(1)).alias("total_invoices"),
            F.count_if("paid").alias("paid_invoices"),
        )
    )


def _revenue_by_method(
    subscriptions: DataFrame, invoices: DataFrame, unique_keys: bool, repeated: bool
) -> DataFrame:
    paying = _paying(subscriptions)
    joined = paying.join(_invoices_per_subscription(invoices), "subscription_id", "left")
    copies = "coalesce(invoices, 1L)" if repeated else "1L"
    by_method = joined.groupBy("collection_method").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.expr(f"CAST({exact_sum_sql('mrr_amount', copies)} AS DECIMAL(38,6)) AS total_mrr"),
        F.coalesce(F.sum("named_invoices"), F.lit(0)).alias("total_invoices"),
        F.coalesce(F.sum("paid_invoices"), F.lit(0)).alias("paid_invoices"),
    )
    if not unique_keys:
        # Swap the summed counts for distinct ones.  One row per method on each
        # side: stacking and summing pairs NULL methods too.
        zero = F.lit(0).cast("bigint")
        counted = _distinct_invoices(paying, invoices).select(
            "collection_method",
            zero.alias("customers"),
            F.lit(None).cast("decimal(38,6)").alias("total_mrr"),
            "total_invoices",
            "paid_invoices",
        )
        by_method = (
            by_method.withColumns({"total_invoices": zero, "paid_invoices": zero})
            .unionByName(counted)
            .groupBy("collection_method")
            .agg(
                *[
                    F.sum(c).alias(c)
                    for c in ("customers", "total_mrr", "total_invoices", "paid_invoices")
                ]
            )
        )
    return _payment_columns(by_method).orderBy("collection_method")


def revenue_by_collection_method(
    subscriptions: DataFrame, invoices: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Payment success per collection method of active and past-due rows.

    A subscription's amount counts once per invoice.  ``unique_keys`` states
    that both tables hold each id once, as the deduplicating load guarantees;
    invoices are then counted without a second pass.
    """
    return _revenue_by_method(subscriptions, invoices, unique_keys, repeated=True)


def revenue_by_collection_method_unfanned(
    subscriptions: DataFrame, invoices: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """The same report with every subscription's amount counted once."""
    return _revenue_by_method(subscriptions, invoices, unique_keys, repeated=False)


def mrr_growth_trend(summary: DataFrame) -> DataFrame:
    return summary.orderBy("month_start_date").select(
        "month_year",
        "total_mrr",
        "new_mrr",
        "churned_mrr",
        "net_new_mrr",
        "growth_rate",
        "active_customers",
        "churn_rate",
    )


def mrr_trend_analysis(summary: DataFrame) -> DataFrame:
    return summary.orderBy("month_start_date").select(
        "month_year",
        "month_start_date",
        "total_mrr",
        "new_mrr",
        "churned_mrr",
        "net_new_mrr",
        "active_customers",
        "churned_customers",
        "growth_rate",
        "churn_rate",
        "average_revenue_per_user",
    )


def growth_trend_inline(summary: DataFrame) -> DataFrame:
    return summary.orderBy("month_start_date").select(
        "month_year", "total_mrr", "new_mrr", "churned_mrr", "growth_rate"
    )
