"""Calendar months as dates and as plain month numbers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BILLING_PERIOD_DAYS = 30


def month_start(day: Column) -> Column:
    return F.trunc(day, "MONTH")


def month_number(day: Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def month_number_of(day: dt.date) -> int:
    return day.year * 12 + day.month - 1


def month_of_number(number: Column) -> Column:
    return F.add_months(F.make_date(F.lit(1), F.lit(1), F.lit(1)), number - 12)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def number_range(first: Column, last: Column) -> Column:
    """Inclusive integer range; empty when ``first > last`` or either is NULL."""
    empty = F.array().cast("array<int>")
    safe_last = F.when(first <= last, last).otherwise(first)
    return F.when(first <= last, F.sequence(first, safe_last)).otherwise(empty)


def month_calendar(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per month from the earliest start through ``as_of``.

    The row count is bounded by the calendar, not by the input.
    """
    first = subscriptions.agg(month_number(F.to_date(F.min("start_date"))).alias("first"))
    numbers = number_range(F.col("first"), F.lit(month_number_of(as_of)))
    return first.select(F.explode(numbers).alias("month_no"))


def utc(moment: dt.datetime) -> Column:
    """Timestamp literal; a datetime without zone is taken as UTC, whatever the
    zone of the driver's machine."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC))


def calculation_stamp(calculated_at: dt.datetime | None) -> Column:
    return F.current_timestamp() if calculated_at is None else utc(calculated_at)
