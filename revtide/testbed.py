"""The driver's sample tables seen as billing tables.

A deterministic mapping: orders are subscriptions, parts are prices, line items
are subscription items and invoices.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtide.functions.billing import monthly_amount
from revtide.functions.months import utc
from revtide.operators.dedup import keep_first
from revtide.session import short_lived_shuffles

AS_OF = dt.date(2001, 12, 31)
EXTRACTED_AT = dt.datetime(2002, 1, 1)
_EPOCH = dt.datetime(1995, 1, 1)

INVOICE_ORDER = ("created", "_partkey", "_suppkey", "total", "status")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _id(prefix: str, *keys: str):
    parts = [F.lit(prefix)]
    for position, key in enumerate(keys):
        parts += [F.lit("_")] if position else []
        parts.append(F.col(key).cast("string"))
    return F.concat(*parts)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.concat(
        F.lit("billing@"), F.lower(F.regexp_replace("c_name", "#", "")), F.lit(".com")
    )
    return read(spark, sf_dir, "customer").select(
        _id("cus_", "c_custkey").alias("customer_id"),
        mail.alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("description"),
        utc(_EPOCH).alias("created"),
        F.lit("usd").alias("currency"),
        (F.col("c_acctbal") < 1000).alias("delinquent"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = read(spark, sf_dir, "part").select("p_type").distinct()
    return kinds.select(
        F.concat(F.lit("prod_"), F.lower("p_type")).alias("product_id"),
        F.col("p_type").alias("name"),
        F.lit(True).alias("active"),
    )


# SQL text, shared by everything that looks at a part as a price.
_PRICE_COLUMNS = (
    "concat('price_', p_partkey) AS price_id",
    "concat('prod_', lower(p_type)) AS product_id",
    "CAST(round(p_retailprice * 100) AS BIGINT) AS unit_amount",
    "CASE WHEN p_size <= 2 THEN NULL WHEN p_partkey % 5 <= 1 THEN 'month' "
    "WHEN p_partkey % 5 = 2 THEN 'year' WHEN p_partkey % 5 = 3 THEN 'week' "
    "ELSE 'day' END AS recurring_interval",
)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        *_PRICE_COLUMNS, "TRUE AS active", "'usd' AS currency", "p_brand AS nickname"
    )


def first_items(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """First item per order; the minimum is also taken before the shuffle.

    ``only`` is a condition on the order's ``key``.
    """
    item = F.expr(
        "min(struct(l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity))"
    )
    items = _of_orders(read(spark, sf_dir, "lineitem"), "l_orderkey", only)
    firsts = items.groupBy("l_orderkey").agg(item.alias("item"))
    return firsts.selectExpr(
        "l_orderkey",
        "item.l_partkey AS item_partkey",
        "CAST(item.l_quantity AS BIGINT) AS item_quantity",
    )


def _order_facts(orders: DataFrame, *more) -> DataFrame:
    early = "o_orderstatus = 'O' AND o_orderkey % 50 = 0"
    start = "CAST(o_orderdate AS DATE)"
    facts = (
        "o_orderkey",
        "concat('sub_', o_orderkey) AS subscription_id",
        "concat('cus_', o_custkey) AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'active' "
        "WHEN 'P' THEN 'past_due' END AS status",
        f"CAST({start} AS TIMESTAMP) AS start_date",
        f"CAST(date_add({start}, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 400 + 1 AS INT) "
        f"WHEN {early} THEN 30 END) AS TIMESTAMP) AS canceled_at",
        f"{early} AS cancel_at_period_end",
        "IF(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'send_invoice', 'charge_automatically') "
        "AS collection_method",
    )
    return orders.select(*[F.expr(fact) for fact in facts], *more)


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lookups are on unique keys the optimizer knows about, so a plan
    that needs no price or quantity drops them."""
    price = read(spark, sf_dir, "part").dropDuplicates(["p_partkey"])
    orders = _order_facts(read(spark, sf_dir, "orders"))
    joined = orders.join(
        first_items(spark, sf_dir), F.expr("o_orderkey = l_orderkey"), "left"
    ).join(price.selectExpr("p_partkey", *_PRICE_COLUMNS), F.expr("item_partkey = p_partkey"), "left")
    amount = monthly_amount(F.col("unit_amount"), F.col("quantity"), F.col("recurring_interval"))
    return (
        joined.withColumn("quantity", F.expr("coalesce(item_quantity, 1L)"))
        .select(
            *[c for c in orders.columns if c != "o_orderkey"],
            F.col("start_date").alias("created"),
            "price_id",
            "product_id",
            "unit_amount",
            "quantity",
            amount.alias("mrr_amount"),
        )
    )


# What an invoice takes from a line item; shuffles carry this instead of the texts made of it.
_ITEM_COLUMNS = (
    "l_orderkey AS _orderkey",
    "l_linenumber AS _linenumber",
    "l_partkey AS _partkey",
    "l_suppkey AS _suppkey",
    "CASE WHEN l_linestatus = 'F' THEN 'paid' WHEN l_returnflag = 'R' THEN 'uncollectible' "
    "WHEN l_returnflag = 'A' THEN 'open' WHEN l_returnflag = 'N' THEN 'void' END AS status",
    "CAST(round(l_extendedprice * 100) AS BIGINT) AS total",
    "CAST(l_shipdate AS TIMESTAMP) AS created",
)


def _invoice_facts(items: DataFrame, *more) -> DataFrame:
    paid = "status = 'paid'"
    facts = (
        "concat('in_', _orderkey, '_', _linenumber) AS invoice_id",
        "IF(_linenumber <> 7, concat('sub_', _orderkey), NULL) AS subscription_id",
        "status",
        "total",
        f"IF({paid}, total, 0L) AS amount_paid",
        f"IF({paid}, 0L, total) AS amount_remaining",
        "created",
        f"IF({paid}, created, NULL) AS paid_at",
        "_orderkey",
        "_linenumber",
        "_partkey",
        "_suppkey",
    )
    return items.select(*[F.expr(fact) for fact in facts], *more)


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as delivered, with repeated ids."""
    return _invoice_facts(read(spark, sf_dir, "lineitem").selectExpr(*_ITEM_COLUMNS))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices after keep-first, without the customer.

    The id is made of the two numeric keys, which sort faster.
    """
    raw = raw_invoices(spark, sf_dir)
    return keep_first(raw, ("_orderkey", "_linenumber"), INVOICE_ORDER).drop(
        "_partkey", "_suppkey", "_linenumber"
    )


def with_customer(spark: SparkSession, sf_dir: str, invoice_rows: DataFrame) -> DataFrame:
    owner = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_orderkey"), _id("cus_", "o_custkey").alias("customer_id")
    )
    return invoice_rows.join(owner, "_orderkey").drop("_orderkey")


_DAY = 86_400


def _seconds(day):
    return F.unix_date(day).cast("bigint") * _DAY


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested customer objects as JSON text.

    By key: the clock is an object, plain text or missing; payment settings or
    the payment method are missing.
    """
    key = F.col("c_custkey")
    rows = customers(spark, sf_dir).select("customer_id", "email", "name", "description", "delinquent")
    rows = rows.withColumn("c_custkey", F.substring("customer_id", 5, 20).cast("bigint"))
    method = F.when(key % 5 != 0, F.concat(F.lit("pm_"), key.cast("string")))
    common = [
        F.col("customer_id").alias("id"),
        "email",
        "name",
        "description",
        (F.lit(9131 * _DAY) + key * 60).alias("created"),
        F.lit("usd").alias("currency"),
        "delinquent",
        F.when(key % 4 != 0, F.struct(method.alias("default_payment_method"))).alias("invoice_settings"),
    ]
    clock = F.concat(F.lit("clock_"), (key % 7).cast("string"))
    as_object = F.to_json(F.struct(*common, F.struct(clock.alias("id")).alias("test_clock")))
    as_text = F.to_json(F.struct(*common, F.when(key % 3 == 1, clock).alias("test_clock")))
    return rows.select(F.when(key % 3 == 0, as_object).otherwise(as_text).alias("value"))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.length("name").cast("bigint") * _DAY
    line = F.struct(
        F.col("product_id").alias("id"),
        "name",
        F.concat(F.lit("Plan "), F.lower("name")).alias("description"),
        "active",
        (F.lit(9131 * _DAY) + age).alias("created"),
        (F.lit(9131 * _DAY) + age * 2).alias("updated"),
    )
    return products(spark, sf_dir).select(F.to_json(line).alias("value"))


def _recurring(interval, count):
    return F.struct(interval.alias("interval"), count.alias("interval_count"))


def price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prices(spark, sf_dir)
    key = F.substring("price_id", 7, 20).cast("bigint")
    recurring = F.when(
        F.col("recurring_interval").isNotNull(), _recurring(F.col("recurring_interval"), key % 3 + 1)
    )
    line = F.struct(
        F.col("price_id").alias("id"),
        F.col("product_id").alias("product"),
        "active",
        "currency",
        "unit_amount",
        recurring.alias("recurring"),
        "nickname",
        (F.lit(9131 * _DAY) + key).alias("created"),
    )
    return rows.select(F.to_json(line).alias("value"))


def subscription_lines(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """Nested subscription objects as JSON text, with every optional part
    missing or zero for some keys; ``only`` is a condition on the order's ``key``."""
    # Texts are made after the joins, so that no shuffle carries them.
    orders = _of_orders(read(spark, sf_dir, "orders"), "o_orderkey", only).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    price = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice", "p_size")
    joined = (
        orders.join(first_items(spark, sf_dir, only), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(price, F.col("item_partkey") == F.col("p_partkey"), "left")
    )
    key = F.col("o_orderkey")
    has_price = F.col("p_partkey").isNotNull()
    rows = _order_facts(
        joined, "item_quantity", *[F.when(has_price, F.expr(made)).alias(made.split(" AS ")[-1]) for made in _PRICE_COLUMNS]
    )
    start, end = _seconds(F.to_date("start_date")), _seconds(F.to_date("canceled_at"))
    zero = F.lit(0).cast("bigint")

    recurring = F.when(
        F.col("recurring_interval").isNotNull(),
        _recurring(F.when(key % 17 != 0, F.col("recurring_interval")), F.lit(1)),
    )
    item_price = F.struct(
        F.col("price_id").alias("id"),
        F.col("product_id").alias("product"),
        F.when(key % 13 != 0, F.col("unit_amount")).alias("unit_amount"),
        recurring.alias("recurring"),
    )
    item = F.struct(
        F.when(key % 11 == 0, zero).otherwise(F.col("item_quantity")).alias("quantity"),
        F.when(key % 7 == 1, zero).when(key % 7 != 0, start + _DAY).alias("current_period_start"),
        F.when(key % 5 != 0, start + 31 * _DAY).alias("current_period_end"),
        F.when(key % 31 != 0, item_price).alias("price"),
    )
    has_item = F.col("price_id").isNotNull() & (key % 29 != 0)
    line = F.struct(
        F.col("subscription_id").alias("id"),
        F.col("customer_id").alias("customer"),
        "status",
        F.when(key % 19 == 1, zero).when(key % 19 != 0, start).alias("start_date"),
        F.when(key % 23 != 0, start).alias("created"),
        F.when(F.col("status") == "canceled", end).alias("ended_at"),
        end.alias("canceled_at"),
        F.when(key % 2 == 1, F.col("cancel_at_period_end")).alias("cancel_at_period_end"),
        "collection_method",
        F.when(key % 9 == 1, "eur").when(key % 9 > 1, "usd").alias("currency"),
        F.when(key % 3 != 0, start + 3600).alias("billing_cycle_anchor"),
        F.when(has_item, F.struct(F.array(item).alias("data"))).alias("items"),
    )
    return rows.select(F.to_json(line).alias("value"))


def _invoice_text(items: DataFrame) -> DataFrame:
    rows = _invoice_facts(items, _id("cus_", "o_custkey").alias("customer_id"))
    part = F.col("_partkey")
    created = _seconds(F.to_date("created"))
    zero = F.lit(0).cast("bigint")
    paid_at = _seconds(F.to_date("paid_at"))
    line = F.struct(
        F.col("invoice_id").alias("id"),
        F.concat(F.lit("N-"), F.substring("invoice_id", 4, 40)).alias("number"),
        F.col("customer_id").alias("customer"),
        F.col("subscription_id").alias("subscription"),
        "status",
        F.col("total").alias("amount_due"),
        "amount_paid",
        "amount_remaining",
        F.col("total").alias("subtotal"),
        "total",
        F.lit("usd").alias("currency"),
        created.alias("created"),
        F.when(part % 3 == 0, zero).when(part % 3 == 1, created + 7 * _DAY).alias("due_date"),
        created.alias("period_start"),
        F.when(part % 2 == 0, created + 30 * _DAY).alias("period_end"),
        F.when(part % 5 != 0, F.struct(paid_at.alias("paid_at"))).alias("status_transitions"),
        F.lit("charge_automatically").alias("collection_method"),
        F.concat(F.lit("https://pay.invalid/"), "invoice_id").alias("hosted_invoice_url"),
        F.concat(F.lit("https://pay.invalid/"), "invoice_id", F.lit(".pdf")).alias("invoice_pdf"),
    )
    return rows.select(F.to_json(line).alias("value"))


def _of_orders(rows: DataFrame, key: str, only: str) -> DataFrame:
    return rows.withColumn("key", F.col(key)).filter(only).drop("key")


def _owned_items(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    items = _of_orders(read(spark, sf_dir, "lineitem"), "l_orderkey", only).selectExpr(*_ITEM_COLUMNS)
    owner = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS _orderkey", "o_custkey")
    return items.join(owner, "_orderkey")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested invoice objects as JSON text, repeated ids included."""
    return _invoice_text(_owned_items(spark, sf_dir))


def delivered_invoice_lines(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """``invoice_lines``, all copies of an id in one partition and in keep-first order.

    The join has dealt the items by order, so the window needs no other shuffle,
    and it keeps adaptive execution from splitting an order's items.  It leaves
    the rows sorted.  Texts are made last and are not shuffled.
    """
    copies = ("_orderkey", "_linenumber")
    turn = F.row_number().over(Window.partitionBy(*copies).orderBy(*INVOICE_ORDER))
    items = _owned_items(spark, sf_dir, only).withColumn("_turn", turn).filter("_turn > 0")  # all; an unused window is dropped
    return _invoice_text(items.sortWithinPartitions(*copies, *INVOICE_ORDER))


LINES = {
    "customers": customer_lines,
    "products": product_lines,
    "prices": price_lines,
    "subscriptions": subscription_lines,
    "invoices": invoice_lines,
}


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files in gzip, at its fastest level: less time for some more bytes."""
    writer = lines.write.mode("overwrite").option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").text(path)


def write_landing(spark: SparkSession, sf_dir: str, folder: str, part=None, orders: str = "true") -> dict[str, str]:
    """Landing files of all entities; returns their paths.

    ``part`` may take an entity's name and lines and say which of them are
    delivered, or None for an entity that is not.  Of subscriptions and invoices
    only those come whose order's ``key`` meets the condition ``orders``, so that
    what is not delivered need not be joined.

    The files are compressed.  Copies of an invoice follow each other in
    keep-first order.
    """
    paths = {}
    for entity, lines in (LINES | {"invoices": delivered_invoice_lines}).items():
        frame = lines(spark, sf_dir, orders) if entity in ("subscriptions", "invoices") else lines(spark, sf_dir)
        # A generator: a filter on the text would be moved below and make the text again.
        if part is not None and (frame := part(entity, frame.select(F.explode(F.array("value")).alias("value")))) is None:
            continue
        paths[entity] = f"{folder}/{entity}"
        with short_lived_shuffles(spark):
            write_lines(frame.select("value"), paths[entity])
    return paths
