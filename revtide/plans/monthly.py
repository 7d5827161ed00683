"""Monthly recurring-revenue metrics and the stored monthly summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions.money import growth_percent, zeros_for_nulls
from revtide.functions.months import calculation_stamp, month_calendar, month_key, month_of_number
from revtide.operators.activity import COUNTS, month_ledger


def month_series(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    month = month_of_number(F.col("month_no"))
    return month_calendar(subscriptions, as_of).select(
        month_key(month).alias("month_year"), month.alias("month_start_date")
    )


def monthly_metrics(
    subscriptions: DataFrame, as_of: dt.date, calculated_at: dt.datetime | None = None
) -> DataFrame:
    """Revenue and customer counts per month that had any activity.

    Empty months are dropped before the previous month is looked up.  The
    churn rate is a fraction of the same month's active customers.
    """
    rows = (
        month_ledger(subscriptions, as_of)
        .withColumn("month_start_date", month_of_number(F.col("month_no")))
        .selectExpr(
            "month_start_date",
            *[f"CAST({c} AS DOUBLE) AS {c}" for c in ("total_mrr", "new_mrr", "churned_mrr")],
            *COUNTS,
        )
    )
    return rows.select(
        month_key(F.col("month_start_date")).alias("month_year"),
        "month_start_date",
        "total_mrr",
        "new_mrr",
        F.expr("0.0D AS expansion_mrr"),
        F.expr("0.0D AS contraction_mrr"),
        "churned_mrr",
        F.expr("new_mrr - churned_mrr AS net_new_mrr"),
        *COUNTS,
        F.expr("try_divide(total_mrr, active_customers) AS average_revenue_per_user"),
        F.expr("try_divide(churned_customers, active_customers) AS churn_rate"),
        F.expr("lag(total_mrr) OVER (ORDER BY month_start_date) AS prev_month_mrr"),
        calculation_stamp(calculated_at).alias("calculated_at"),
    ).orderBy("month_start_date")


def monthly_summary(
    subscriptions: DataFrame, as_of: dt.date, calculated_at: dt.datetime | None = None
) -> DataFrame:
    """The stored form: growth in percent, missing values as zero."""
    doubles = ("total_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "net_new_mrr")
    return monthly_metrics(subscriptions, as_of, calculated_at).select(
        "month_year",
        "month_start_date",
        *zeros_for_nulls(doubles, "double"),
        *zeros_for_nulls(COUNTS, "bigint"),
        *zeros_for_nulls(("average_revenue_per_user", "churn_rate"), "double"),
        growth_percent("total_mrr", "prev_month_mrr").alias("growth_rate"),
        "calculated_at",
    )
