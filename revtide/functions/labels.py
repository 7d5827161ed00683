"""Display strings for the dashboard tables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_label(status: Column) -> Column:
    """Upper-case first letter; the first underscore after it as a space."""
    rest = F.substring(status, F.lit(2), F.length(status))
    spaced = F.regexp_replace(rest, "^([^_]*)_", "$1 ")
    return F.concat(F.upper(F.substring(status, 1, 1)), spaced)


def dollars(value: Column) -> Column:
    """Whole US dollars with thousands separators, minus sign first."""
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), F.format_number(F.round(F.abs(value)), 0))


def one_decimal(value: Column) -> Column:
    """One decimal place, rounding the exact binary value, ties away from zero.

    ``20 * |x|`` is formed as ``16|x| + 4|x|``; both terms are exact, and the
    part lost when they are added is recovered, so the comparison with the
    halfway point is exact.
    """
    x = F.abs(value)
    tenths = F.floor(x * 10)
    large, small = x * 16, x * 4
    total = large + small
    lost = small - (total - large)
    # x*10 itself may round up to the next integer; step back when it did.
    overshoot = (total < tenths * 2) | ((total == tenths * 2) & (lost < 0))
    tenths = F.when(overshoot, tenths - 1).otherwise(tenths)
    halfway = (tenths * 2 + 1).cast("double")
    up = (total > halfway) | ((total == halfway) & (lost >= 0))
    digits = (tenths + F.when(up, 1).otherwise(0)).cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(digits / 10).cast("bigint").cast("string")
    return F.concat(sign, whole, F.lit("."), (digits % 10).cast("string"))


def percent(value: Column) -> Column:
    return F.concat(one_decimal(value), F.lit("%"))


def signed_percent_or_dash(value: Column) -> Column:
    sign = F.when(value >= 0, F.lit("+")).otherwise(F.lit(""))
    shown = F.concat(sign, percent(value))
    return F.when(value.isNull() | (value == 0), F.lit("-")).otherwise(shown)


def trend_note(value: Column) -> Column:
    arrow = F.when(value >= 0, F.lit("↑")).otherwise(F.lit("↓"))
    return F.concat(arrow, F.lit(" "), percent(F.abs(value)), F.lit(" from last month"))


def thousands_tick(value: Column) -> Column:
    """Axis tick such as ``$12.5k``: shortest decimal text, no trailing zeros."""
    text = (value / 1000).cast("decimal(38,20)").cast("string")
    return F.concat(F.lit("$"), F.regexp_replace(text, r"\.?0+$", ""), F.lit("k"))
