"""Order-independent money sums and safe ratios."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum_sql(amount: str, copies: str = "1L") -> str:
    """SQL for the sum of ``amount * copies`` as DECIMAL, exact to a millionth.

    Row amounts are doubles.  Summing doubles depends on the order in which
    partitions arrive; summing decimals per row is slow.  So whole units and
    millionths are summed as two longs and put together once per group.
    """
    whole = f"floor({amount})"
    millionths = f"CAST(rint(({amount} - {whole}) * 1000000D) AS BIGINT)"
    return (
        f"(CAST(sum({whole} * {copies}) AS DECIMAL(20,0)) + "
        f"CAST(sum({millionths} * {copies}) AS DECIMAL(20,0)) * 0.000001BD)"
    )


def exact_sum(amount: str) -> Column:
    return F.expr(f"CAST({exact_sum_sql(amount)} AS DOUBLE)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def zeros_for_nulls(names: Iterable[str], kind: str) -> list[Column]:
    return [F.expr(f"CAST(coalesce({n}, 0) AS {kind}) AS {n}") for n in names]


def growth_percent(current: str, previous: str) -> Column:
    """Percent change; 0.0 without a positive previous value."""
    change = f"try_divide({current} - {previous}, {previous}) * 100"
    return F.expr(f"CASE WHEN {previous} > 0 THEN {change} ELSE 0.0D END")
