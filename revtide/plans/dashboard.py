"""Payloads behind the dashboard: API series, KPI cards, table and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions.labels import (
    dollars,
    percent,
    signed_percent_or_dash,
    status_label,
    thousands_tick,
    trend_note,
)
from revtide.plans.reports import subscription_status_summary


def _filled(name: str, kind: str, alias: str, factor: str = "") -> str:
    return f"CAST(coalesce({name}, 0) AS {kind}){factor} AS {alias}"


def api_mrr_trend(summary: DataFrame) -> DataFrame:
    """Monthly series with camel-case names; churn rate in percent."""
    return summary.orderBy("month_start_date").selectExpr(
        "month_year AS month",
        "date_format(month_start_date, 'MMM yyyy') AS monthLabel",
        _filled("total_mrr", "double", "totalMrr"),
        _filled("new_mrr", "double", "newMrr"),
        _filled("churned_mrr", "double", "churnedMrr"),
        _filled("net_new_mrr", "double", "netNewMrr"),
        _filled("active_customers", "bigint", "activeCustomers"),
        _filled("churned_customers", "bigint", "churnedCustomers"),
        _filled("growth_rate", "double", "growthRate"),
        _filled("churn_rate", "double", "churnRate", " * 100"),
        _filled("average_revenue_per_user", "double", "arpu"),
    )


def api_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscription_status_summary(subscriptions).selectExpr(
        "status", "count", _filled("mrr", "double", "mrr")
    )


def api_summary(summary: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Latest month's figures with status counts nested; no row without a month."""
    latest = summary.orderBy(F.desc("month_start_date")).limit(1)
    counts = subscriptions.agg(
        F.struct(
            F.count_if(F.col("status") == "active").alias("active"),
            F.count_if(F.col("status") == "canceled").alias("canceled"),
            F.count_if(F.col("status") == "past_due").alias("pastDue"),
        ).alias("subscriptions")
    )
    # One row on each side.
    return latest.join(F.broadcast(counts), F.lit(True)).selectExpr(
        _filled("total_mrr", "double", "currentMrr"),
        _filled("active_customers", "bigint", "activeCustomers"),
        _filled("average_revenue_per_user", "double", "arpu"),
        _filled("churn_rate", "double", "churnRate", " * 100"),
        _filled("growth_rate", "double", "growthRate"),
        "subscriptions",
    )


def pie_series(subscriptions: DataFrame) -> DataFrame:
    return api_subscriptions(subscriptions).select(
        status_label(F.col("status")).alias("name"), F.col("count").alias("value")
    )


def monthly_table(trend: DataFrame) -> DataFrame:
    """Formatted monthly rows from the API series."""
    return trend.select(
        "month",
        dollars(F.col("totalMrr")).alias("total_mrr"),
        F.concat(F.lit("+"), dollars(F.col("newMrr"))).alias("new_mrr"),
        F.concat(F.lit("-"), dollars(F.col("churnedMrr"))).alias("churned_mrr"),
        dollars(F.col("netNewMrr")).alias("net_new"),
        F.col("activeCustomers").alias("customers"),
        signed_percent_or_dash(F.col("growthRate")).alias("growth"),
    )


def kpi_cards(api_summary_row: DataFrame) -> DataFrame:
    """Four cards: title, value, subtitle, trend."""
    nothing = F.lit(None).cast("string")

    def card(position: int, title: str, value, subtitle=nothing, trend=nothing):
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(title).alias("title"),
            value.alias("value"),
            subtitle.alias("subtitle"),
            trend.alias("trend"),
        )

    counts = F.col("subscriptions")
    cards = F.array(
        card(1, "Current MRR", dollars(F.col("currentMrr")), trend=trend_note(F.col("growthRate"))),
        card(
            2,
            "Active Customers",
            F.col("activeCustomers").cast("string"),
            F.concat(counts["pastDue"].cast("string"), F.lit(" past due")),
        ),
        card(3, "ARPU", dollars(F.col("arpu")), F.lit("Average Revenue Per User")),
        card(
            4,
            "Churn Rate",
            percent(F.col("churnRate")),
            F.concat(counts["canceled"].cast("string"), F.lit(" canceled")),
        ),
    )
    return api_summary_row.select(F.inline(cards))


def chart_series(trend: DataFrame) -> DataFrame:
    """The three charts' points in long form: chart, month, series, value, tick."""
    def point(chart: str, series: str, column: str, tick=None):
        return F.struct(
            F.lit(chart).alias("chart"),
            F.lit(series).alias("series"),
            F.col(column).cast("double").alias("value"),
            (F.lit(None).cast("string") if tick is None else tick).alias("tick"),
        )

    points = F.array(
        point("mrr_trend", "MRR", "totalMrr", thousands_tick(F.col("totalMrr"))),
        point("mrr_trend", "Active Subscriptions", "activeCustomers"),
        point("new_vs_churned", "New MRR", "newMrr"),
        point("new_vs_churned", "Churned MRR", "churnedMrr"),
        point("customer_growth", "Active Customers", "activeCustomers"),
    )
    return trend.select("month", F.inline(points))
