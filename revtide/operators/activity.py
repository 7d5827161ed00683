"""Subscription activity on the month grid, without a month cross join.

A subscription is active over one run of months.  The run's first month comes
from the day before the start (a start on the 1st already counts in the month
before), its last month from the cancellation.  Months are plain numbers here.

Distinct customers per month come from per-customer bitmaps: one long holds 64
months, runs become bit ranges, and the bitmaps of a customer are OR-ed.  The
OR runs before the shuffle too, so a customer with a third of all
subscriptions leaves each task as a few rows.

Amounts per month come from sums per (first, last) run, of which there are at
most as many as pairs of calendar months, turned into +/- steps and
accumulated.

Expressions are SQL text: each one is a single call into the JVM.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.money import exact_sum_sql
from revtide.functions.months import month_number_of

WORD_BITS = 64
AMOUNTS = ("step", "new_mrr", "churned_mrr")
COUNTS = ("active_customers", "new_customers", "churned_customers")


def month_number_sql(day: str) -> str:
    return f"(year({day}) * 12 + month({day}) - 1)"


FIRST_ACTIVE_MONTH_SQL = month_number_sql("date_sub(to_date(start_date), 1)")


def month_facts(subscriptions: DataFrame, as_of: dt.date, *keep: str) -> DataFrame:
    """Start, cancel and active-run month numbers, cut at ``as_of``.

    A cancellation ends the run with the month before it.  Without a start the
    run is NULL, while the cancellation still counts.
    """
    horizon = month_number_of(as_of)
    numbered = subscriptions.selectExpr(
        *keep,
        f"{FIRST_ACTIVE_MONTH_SQL} AS first_month",
        f"{month_number_sql('to_date(start_date)')} AS start_month",
        f"{month_number_sql('to_date(canceled_at)')} AS cancel_month",
    )
    last = f"least(cancel_month - 1, {horizon})"
    return numbered.selectExpr(
        *keep,
        f"CASE WHEN first_month <= {last} THEN first_month END AS first_month",
        f"CASE WHEN first_month <= {last} THEN {last} END AS last_month",
        f"CASE WHEN start_month <= {horizon} THEN start_month END AS start_month",
        f"CASE WHEN cancel_month <= {horizon} THEN cancel_month END AS cancel_month",
    )


def bit_range_sql(first: str, last: str) -> str:
    """A long with bits ``first..last`` set, cut to 0..63.

    Zero when the range is empty or an end is NULL (``greatest`` and ``least``
    skip NULLs, hence the explicit test).
    """
    low, high = f"greatest({first}, 0)", f"least({last}, {WORD_BITS - 1})"
    ones = f"shiftrightunsigned(-1L, {WORD_BITS - 1} - ({high} - {low}))"
    return (
        f"CASE WHEN {first} IS NOT NULL AND {last} IS NOT NULL AND {low} <= {high} "
        f"THEN shiftleft({ones}, {low}) ELSE 0L END"
    )


def customer_bitmaps(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Per customer and 64-month word: months active, started in, canceled in.

    Words are laid out backwards from the as-of month, so the number of words
    a customer needs depends on its age only.  ``base`` is a word's first
    month.
    """
    horizon = month_number_of(as_of)
    facts = month_facts(subscriptions, as_of, "customer_id").filter("customer_id IS NOT NULL")
    # All NULL when nothing happened by the horizon; NULL explodes to no row.
    newest = f"({horizon} - greatest(last_month, start_month, cancel_month)) div {WORD_BITS}"
    oldest = f"({horizon} - least(first_month, start_month, cancel_month)) div {WORD_BITS}"
    words = facts.selectExpr("*", f"explode(sequence({newest}, {oldest})) AS word").selectExpr(
        "*", f"CAST({horizon + 1} - {WORD_BITS} * (word + 1) AS INT) AS base"
    )

    def within(first: str, last: str, name: str) -> str:
        return f"{bit_range_sql(f'({first} - base)', f'({last} - base)')} AS {name}"

    masks = words.selectExpr(
        "customer_id",
        "base",
        within("first_month", "last_month", "active"),
        within("start_month", "start_month", "started"),
        within("cancel_month", "cancel_month", "canceled"),
    )
    return masks.groupBy("customer_id", "base").agg(
        F.bit_or("active").alias("active"),
        F.bit_or("started").alias("started"),
        F.bit_or("canceled").alias("canceled"),
    )


def customers_per_month(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct active, new and churned customers, as addends per month number.

    The bitmaps are counted a byte at a time: equal bytes collapse into one row
    with a count before the shuffle, and only those few rows are taken apart
    into months.  A month may appear in several rows.
    """
    sources = ("active", "started", "canceled")
    tallies = (
        customer_bitmaps(subscriptions, as_of)
        .selectExpr("*", f"explode(sequence(0, {WORD_BITS - 8}, 8)) AS shift")
        .selectExpr(
            "base + shift AS base",
            *[f"shiftrightunsigned({c}, shift) & 255L AS {c}" for c in sources],
        )
        .filter("active <> 0 OR started <> 0 OR canceled <> 0")
        .groupBy("base", *sources)
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return tallies.selectExpr("*", "explode(sequence(0, 7)) AS bit").selectExpr(
        "base + bit AS month_no",
        *[
            f"(shiftrightunsigned({c}, bit) & 1L) * customers AS {n}"
            for c, n in zip(sources, COUNTS)
        ],
    )


def amount_steps(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Changes of the running total, new and churned amounts and the number of
    starts, as addends per month number."""
    runs = (
        month_facts(subscriptions, as_of, "mrr_amount")
        .groupBy("first_month", "last_month", "start_month", "cancel_month")
        .agg(
            F.expr(f"CAST({exact_sum_sql('mrr_amount')} AS DECIMAL(38,6)) AS amount"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("none", F.expr("CAST(0 AS DECIMAL(38,6))"))
        .withColumn("less", F.expr("CAST(-amount AS DECIMAL(38,6))"))
    )
    return runs.selectExpr(
        """stack(4,
             first_month, amount, none, none, 0L,
             last_month + 1, less, none, none, 0L,
             start_month, none, amount, none, rows,
             cancel_month, none, none, amount, 0L) AS (month_no, step, new_mrr, churned_mrr, starts)"""
    ).filter("month_no IS NOT NULL")


def month_ledger(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Exact amounts and distinct counts per month that had any customer active,
    new or churned, from the first start month on.

    The two pieces are stacked and summed per month instead of joined.  A month
    in neither piece had no activity at all, so no calendar is needed to find
    it.  From the sums on there is one row per month: the ordered window over
    all of them fits one task at any input size.
    """
    amounts = amount_steps(subscriptions, as_of).selectExpr(
        "month_no", *AMOUNTS, "starts", *[f"0L AS {c}" for c in COUNTS]
    )
    customers = customers_per_month(subscriptions, as_of).selectExpr(
        "month_no", *[f"CAST(0 AS DECIMAL(38,6)) AS {c}" for c in AMOUNTS], "0L AS starts", *COUNTS
    )
    monthly = (
        amounts.unionAll(customers)
        .groupBy("month_no")
        .agg(*[F.expr(f"sum({c}) AS {c}") for c in (*AMOUNTS, "starts", *COUNTS)])
    )
    upto = Window.orderBy("month_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        monthly.withColumn("total_mrr", F.sum("step").over(upto))
        .withColumn("started_by_now", F.sum("starts").over(upto))
        .filter("started_by_now > 0")
        .filter("active_customers > 0 OR new_customers > 0 OR churned_customers > 0")
    )
