import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from revtide.functions import labels


def shown(spark, fn, values, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in frame.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_one_decimal_rounds_the_exact_binary_value(spark):
    rng = random.Random(5)
    values = [0.35, 0.25, 0.75, 0.05, 0.15, 1.45, 8.345, 99.95, 1e6 + 0.05, 0.0, 123.45, 2.5, -0.25, -7.75]
    values += [rng.uniform(-500, 500) for _ in range(300)] + [k / 20 for k in range(-200, 200)]
    expected = [str(Decimal(v).quantize(Decimal("0.1"), ROUND_HALF_UP)) for v in values]
    got = shown(spark, labels.one_decimal, values)
    # A value that rounds to zero keeps its sign only when it is negative.
    expected = ["0.0" if e in ("0.0", "-0.0") and v >= 0 else e for e, v in zip(expected, values)]
    assert got == expected


def test_dollars(spark):
    values = [0.0, 2.5, 999.5, 1234567.49, -2.5, -1234.2, -0.4]
    assert shown(spark, labels.dollars, values) == [
        "$0", "$3", "$1,000", "$1,234,567", "-$3", "-$1,234", "-$0",
    ]


def test_status_label_replaces_the_first_underscore(spark):
    values = ["past_due", "active", "incomplete_expired_x", "a", "_b"]
    assert shown(spark, labels.status_label, values, "string") == [
        "Past due", "Active", "Incomplete expired_x", "A", "_b",
    ]


def test_signed_percent_and_trend(spark):
    assert shown(spark, labels.signed_percent_or_dash, [0.0, None, 12.34, -3.0]) == [
        "-", "-", "+12.3%", "-3.0%",
    ]
    assert shown(spark, labels.trend_note, [-3.21, 0.0]) == [
        "↓ 3.2% from last month", "↑ 0.0% from last month",
    ]


def test_thousands_tick(spark):
    assert shown(spark, labels.thousands_tick, [0.0, 100000.0, 12500.0, 50.0, 1.5e10]) == [
        "$0k", "$100k", "$12.5k", "$0.05k", "$15000000k",
    ]
