"""Scalar rules that turn billing objects into table values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Minor units per major unit, months per year, weeks per month.
MINOR_UNITS = 100
MONTHS_PER_YEAR = 12
WEEKS_PER_MONTH = 4.33


def or_default(value: Column, default: Column) -> Column:
    """``default`` when the number is NULL or zero."""
    return F.coalesce(F.nullif(value, F.lit(0)), default)


def epoch_or_null(seconds: Column) -> Column:
    """Epoch seconds to timestamp; zero and NULL mean "not set"."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def first_element(items: Column) -> Column:
    """First array element, NULL for an empty or missing array."""
    return F.get(items, F.lit(0))


def monthly_amount(unit_amount: Column, quantity: Column, interval: Column) -> Column:
    """Monthly recurring amount in major units; unknown intervals count as zero."""
    gross = (unit_amount * quantity).cast("double")
    return (
        F.when(interval == "month", gross / MINOR_UNITS)
        .when(interval == "year", gross / MONTHS_PER_YEAR / MINOR_UNITS)
        .when(interval == "week", gross * F.lit(WEEKS_PER_MONTH) / MINOR_UNITS)
        .otherwise(F.lit(0.0))
    )
